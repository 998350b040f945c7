import json
import os

from epistar.operators.warehouse import list_versions, read_current
from epistar.plans import vaccines
from epistar.spec import DIMENSIONS
from epistar.streaming.incremental import stream_source, upsert_batches

SCHEMA = (
    "YearWeekISO string, ReportingCountry string, Region string, TargetGroup string, Vaccine string, "
    "FirstDose long, SecondDose long, NumberDosesReceived string, Population long"
)


def _chunk(folder, name, rows):
    with open(os.path.join(folder, name), "w", encoding="utf8") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")


def _row(week, country, dose):
    return {"YearWeekISO": week, "ReportingCountry": country, "Region": country, "TargetGroup": "ALL",
            "Vaccine": "COM", "FirstDose": dose, "SecondDose": 0, "NumberDosesReceived": "n/a", "Population": 10}


def test_chunked_upsert_stream(spark, scratch):
    src = os.path.join(scratch, "chunks")
    os.makedirs(src)
    _chunk(src, "part-0.json", [_row("2021-W01", "DE", 1), _row("2021-W01", "FR", 2)])
    _chunk(src, "part-1.json", [_row("2021-W01", "DE", 5), _row("2021-W02", "IT", 3)])
    # the file source takes files oldest first
    os.utime(os.path.join(src, "part-0.json"), (1_600_000_000, 1_600_000_000))
    os.utime(os.path.join(src, "part-1.json"), (1_600_000_100, 1_600_000_100))
    wh = os.path.join(scratch, "wh")
    specs = {"dim_country": DIMENSIONS["dim_country"], "dim_vaccine": DIMENSIONS["dim_vaccine"]}

    def transform(batch):
        out = vaccines.transform([batch])
        return {"dim_country": out["dim_country"], "dim_vaccine": out["dim_vaccine"]}

    stream = stream_source(spark, src, SCHEMA, fmt="json", max_files_per_trigger=1)
    q = upsert_batches(stream, transform, specs, wh, "vt_chunks", checkpoint_location=os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    countries = {r.country_code: r.dim_country_key for r in read_current(spark, os.path.join(wh, "dim_country")).collect()}
    assert countries == {"--": -1, "DE": 1, "FR": 2, "IT": 3}
    n_versions = len(list_versions(spark, os.path.join(wh, "dim_country")))
    # restarting from the checkpoint replays nothing
    again = upsert_batches(stream_source(spark, src, SCHEMA), transform, specs, wh, "vt_chunks", checkpoint_location=os.path.join(scratch, "ckpt"))
    again.awaitTermination(120)
    assert len(list_versions(spark, os.path.join(wh, "dim_country"))) == n_versions
