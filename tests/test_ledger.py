"""Files of a prefix are taken once, overwritten files again."""

import os

from martflow.plans import pipeline
from martflow.plans.scenarios import ENTITY_SCHEMAS
from martflow.sources import ledger
from martflow.sources.tables import TableStore

HEADER = ",".join(f.name for f in ENTITY_SCHEMAS["stores"].fields) + "\n"


def put(path, *rows, when):
    width = HEADER.count(",") + 1
    at = [f.name for f in ENTITY_SCHEMAS["stores"].fields].index("created_at")
    with open(path, "w") as f:
        f.write(HEADER)
        for key, time in rows:
            fields = [""] * width
            fields[0], fields[at] = str(key), time
            f.write(",".join(fields) + "\n")
    os.utime(path, (when, when))


def test_only_new_and_overwritten_files_are_read(spark, scratch, monkeypatch):
    root = scratch("landing-files")
    prefix = f"{root}/stores"
    os.makedirs(prefix)
    store = TableStore(spark, scratch("warehouse"))
    read = []
    from martflow.sources import landing
    plain = landing.read_landing
    monkeypatch.setattr(landing, "read_landing", lambda s, path, *a: read.append([os.path.basename(p) for p in path]) or plain(s, path, *a))

    def load():
        del read[:]
        pipeline.load_staging_from_landing(spark, root, store, ENTITY_SCHEMAS, store.root + "-ckpt")
        keys = sorted(str(r[0]) for r in store.read("staging", "stg_stores").collect())
        return sum(read, []), keys, store.read("staging", "stg_stores_quarantine").count()

    day = "2020-01-0{}T00:00:00".format
    put(f"{prefix}/a b+c%41.csv", (1, day(1)), (2, "no time"), when=1_000)
    put(f"{prefix}/b.csv", (3, day(2)), (4, "no time"), when=1_000)
    assert load() == (["a b+c%41.csv", "b.csv"], ["1", "3"], 2)
    assert load() == ([], ["1", "3"], 2)
    put(f"{prefix}/c.csv", (5, day(3)), when=1_000)  # a grown folder
    assert load() == (["c.csv"], ["1", "3", "5"], 2)
    put(f"{prefix}/b.csv", (3, day(2)), (6, day(4)), when=2_000)  # overwritten: its rows above the mark; its bad row is mended
    assert load() == (["b.csv"], ["1", "3", "5", "6"], 1)
    assert load() == ([], ["1", "3", "5", "6"], 1)


def test_the_listing_reads_no_contents_and_sends_no_rows(spark, scratch):
    prefix = scratch("landing-files")
    os.makedirs(prefix)
    put(f"{prefix}/a.csv", (1, "2020-01-01T00:00:00"), when=1_000)
    files = ledger.listing(spark, prefix)
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    assert [(r.length > 0, os.path.basename(r.path)) for r in files.collect()] == [(True, "a.csv")]
    taken = scratch("files")
    ledger.record(ledger.not_taken(spark, prefix, taken), taken)
    assert ledger.paths(ledger.not_taken(spark, prefix, taken)) == []
