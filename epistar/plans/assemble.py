"""D5+D6 as one lazy plan: conform the dimension data sets of all sources,
key them, and resolve every fact's foreign keys, without writing tables.

The result equals loading the sources one after another (``plans.load``) up to
the numbering of surrogate keys: for every business key and column, the last
source that supplies the column wins (a supplied null included), as
successive upserts would leave it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistar.functions.calendar import date_dimension_rows, date_range_between
from epistar.operators.columns import fill_numeric_zero
from epistar.operators.dedupe import union_all
from epistar.operators.keys import assign_consecutive_keys, resolve_foreign_keys, with_unknown_member
from epistar.operators.warehouse import one_row_per_key
from epistar.plans.load import DIMENSION_ORDER, FACT_ORDER, source_order
from epistar.session import cut_lineage
from epistar.spec import DIMENSIONS, FACTS, TableSpec


def conform_dimension(frames: Sequence[DataFrame], spec: TableSpec) -> DataFrame:
    """One row per business key, keyed and written; each column from the last frame supplying it.

    Written, a dimension has a measured size, and joins to it need no shuffle of the fact while it is small.
    """
    keys = list(spec.unique_keys)
    conformed = last_supplied(frames, keys, [c for c in spec.columns if c not in keys], spec, whole_keys=True)
    keyed = assign_consecutive_keys(conformed, keys, spec.surrogate_key)
    return cut_lineage(with_unknown_member(keyed, spec, check=False))


def last_supplied(frames: Sequence[DataFrame], keys: list[str], cols: list[str], spec: TableSpec, whole_keys: bool) -> DataFrame:
    """One row per key over all frames; each column from the last frame that supplies it for the key (a null included)."""
    staged = []
    for order, frame in enumerate(frames):
        names = set(frame.columns)
        present = [c for c in cols if c in names]
        staged.append(
            frame.select(
                *keys,
                *[(F.col(c) if c in present else F.lit(None)).cast(spec.type_of(c)).alias(c) for c in cols],
                F.lit(order).alias("_src"),
                *[F.lit(c in present).alias(f"_has_{c}") for c in cols],
            )
        )
    merged = union_all(*staged)
    if whole_keys:
        merged = merged.dropna(subset=keys)
    aggs = [F.max_by(F.col(c), F.when(F.col(f"_has_{c}"), F.col("_src"))).alias(c) for c in cols]
    return merged.groupBy(*keys).agg(*aggs) if aggs else merged.select(*keys).distinct()


def conform_fact(frames: Sequence[DataFrame], spec: TableSpec) -> DataFrame:
    """H2: one row per key and source (the first one of the source's order), the last source's columns over all.

    One source keeps the types it came with; several are cast to the contract's, as the load does.
    """
    found = [one_row_per_key(f, spec, source_order(f)) for f in frames]
    whole = [f for f in found if f is not None]
    if not whole:
        raise ValueError(f"no source of {spec.name} has its keys")
    if len(whole) == 1:
        return whole[0][0]
    supplied = {c for _, _, cols in whole for c in cols}
    return last_supplied([rows for rows, _, _ in whole], list(spec.unique_keys), [c for c in spec.columns if c in supplied], spec, whole_keys=False)


def calendar_for(facts: Sequence[DataFrame]) -> DataFrame:
    """``dim_date`` spanning every date the facts refer to (bounded by construction)."""
    spans = []
    for fact in facts:
        names = set(fact.columns)
        for c in ("date", "week_start_date", "week_end_date"):
            if c in names:
                spans.append(fact.select(F.col(c).cast("date").alias("d")))
    bounds = union_all(*spans).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    days = bounds.select(F.explode(date_range_between("lo", "hi")).alias("date"))
    return cut_lineage(assign_consecutive_keys(date_dimension_rows(days), ["date"], "dim_date_key"))


def assemble_star(
    outputs: Mapping[str, Mapping[str, DataFrame]],
    source_order: Sequence[str] | None = None,
    dim_specs: Mapping[str, TableSpec] = DIMENSIONS,
    fact_specs: Mapping[str, TableSpec] = FACTS,
    materialize_outputs: bool = False,
    facts: Sequence[str] | None = None,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(dimensions, facts) of the star for the transforms' outputs.

    ``facts`` limits the star to those fact tables and the dimensions they
    reference (the calendar then spans only their dates); by default every
    fact and dimension present in the outputs is built.

    Surrogate keys are fixed by the checkpoint inside key assignment, so a
    dimension read by several facts always shows the same keys. Call the
    transforms with ``materialize=True`` so their shared stage is computed
    once; outputs from elsewhere can be checkpointed with
    ``materialize_outputs``.
    """
    order = list(source_order or sorted(outputs))
    if materialize_outputs:
        used = set(DIMENSION_ORDER) | set(FACT_ORDER)
        outputs = {s: {n: cut_lineage(df) for n, df in outputs[s].items() if n in used} for s in order}
    wanted = [name for name in FACT_ORDER if facts is None or name in facts]
    raw_facts = {name: [outputs[s][name] for s in order if name in outputs[s]] for name in wanted}
    all_fact_frames = [f for frames in raw_facts.values() for f in frames]
    referenced = {dim for name in wanted for _, dim in fact_specs[name].foreign_keys}
    # Dimensions (and the calendar) are independent: their keying jobs are
    # submitted together, and Spark runs them side by side.
    work = {}
    for name in DIMENSION_ORDER:
        if facts is not None and name not in referenced:
            continue
        frames = [outputs[s][name] for s in order if name in outputs[s]]
        if frames:
            # keys are fixed by the checkpoint inside key assignment
            work[name] = (conform_dimension, frames, dim_specs[name])
    if all_fact_frames:
        work["dim_date"] = (lambda frames, _spec: calendar_for(frames), all_fact_frames, None)
    with ThreadPoolExecutor(max_workers=max(1, min(len(work), 4))) as pool:
        futures = {name: pool.submit(fn, frames, spec) for name, (fn, frames, spec) in work.items()}
        dims: dict[str, DataFrame] = {name: f.result() for name, f in futures.items()}
    facts: dict[str, DataFrame] = {}
    for name, frames in raw_facts.items():
        if not frames:
            continue
        # dimensions are written tables here: their file size decides between a broadcast and a shuffle
        spec = fact_specs[name]
        keyed = [fill_numeric_zero(resolve_foreign_keys(f, spec, dims, dim_specs)) for f in frames]
        facts[name] = conform_fact(keyed, spec)
    return dims, facts
