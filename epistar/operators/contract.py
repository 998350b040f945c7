"""Contract checks (H1/H2): nulls, lengths and types of a batch, counted while it is landed.

A batch is written once to the shared folder. That one pass evaluates every rule of
the table's contract, marks the rows that break one, and counts per rule with an
observation, so no scan is made for the counts. Rows that a table cannot hold go to
the quarantine with the names of the rules they break; the others are loaded.
Foreign keys that fell to the unknown member are counted and loaded.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from epistar.session import cut_lineage
from epistar.spec import UNKNOWN_KEY, TableSpec

BROKEN = "_broken_rules"


@dataclass
class ContractReport:
    """Counts per batch and rule of one load, and where its rejected rows lie."""

    quarantine_root: str
    batches: list[dict] = field(default_factory=list)

    def rejected(self, table: str | None = None) -> int:
        return sum(b["rejected"] for b in self.batches if table in (None, b["table"]))


def contract_rules(df: DataFrame, spec: TableSpec) -> dict[str, Column]:
    """Rule name -> whether a row breaks it, for the contract's columns that ``df`` supplies (never null)."""
    rules: dict[str, Column] = {}
    for c in spec.all_columns:
        if c not in df.columns or c == spec.surrogate_key:
            continue
        if c in spec.required:
            rules[f"null:{c}"] = F.col(c).isNull()
        kind = spec.type_of(c)
        if kind != "string":
            rules[f"type:{c}"] = F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()
        elif (most := spec.length_of(c)) is not None:
            rules[f"length:{c}"] = F.coalesce(F.char_length(F.col(c).cast("string")) > most, F.lit(False))
    return rules


def admit(df: DataFrame, spec: TableSpec, source: str, batch_ts: _dt.datetime, report: ContractReport) -> DataFrame:
    """The rows of a batch that ``spec`` can hold; the others are written to the quarantine.

    The quarantine of a (table, batch, source) is one folder that a rerun of the batch writes anew. Its rows are
    (rules, row as JSON), whatever columns the source has. An empty batch gives zero counts and no folder.
    """
    rules = contract_rules(df, spec)
    misses = {f"unknown:{fk}": F.col(fk) == UNKNOWN_KEY for fk, _ in spec.foreign_keys if fk in df.columns}
    seen = Observation(f"{spec.name}-{source}")
    broken = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in rules.items()])) if rules else F.array().cast("array<string>")
    counted = [F.count_if(hit).alias(name) for name, hit in {**rules, **misses}.items()]
    marked = df.withColumn(BROKEN, broken).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size(BROKEN) > 0).alias("rejected"), *counted
    )
    landed = cut_lineage(marked)
    counts = seen.get
    path = f"{report.quarantine_root.rstrip('/')}/{spec.name}/batch={batch_ts:%Y%m%dT%H%M%S}/source={source}"
    report.batches.append(
        {"table": spec.name, "source": source, "rows": counts["rows"], "rejected": counts["rejected"],
         "rules": {name: n for name, n in counts.items() if name not in ("rows", "rejected") and n}}
    )
    if counts["rejected"]:
        row = F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("row")
        landed.where(F.size(BROKEN) > 0).select(F.col(BROKEN).alias("rules"), row).write.mode("overwrite").parquet(path)
    return landed.where(F.size(BROKEN) == 0).drop(BROKEN)
