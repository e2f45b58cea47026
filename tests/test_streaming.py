import json
import random
import time

from priceloom.streaming.buckets import BucketState, FlushSink, run_available
from priceloom.streaming.progress import ProgressListener, ProgressSink, counted, record

ROWS = "k int, v string, at int"


def frame(spark, *rows):
    return spark.createDataFrame(rows, ROWS)


def test_batch_wins_without_order(spark, tmp_path):
    sink = lambda: BucketState(spark, str(tmp_path / "out"), ["k"], None, ROWS, 4)
    sink()(frame(spark, (1, "a", 1), (2, "b", 1)), 0)
    for _ in range(2):  # run again, after a restart
        sink()(frame(spark, (3, "c", 0), (2, None, 0)), 1)
        assert sorted(map(tuple, sink().result().collect())) == [(1, "a", 1), (2, None, 0), (3, "c", 0)]


def test_stream_stopped_and_started(spark, tmp_path):
    for part in range(2):
        frame(spark, (part, "x", part), (9, "y", part)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        sink = BucketState(spark, str(tmp_path / "out"), ["k"], "at")
        run_available(spark.readStream.schema(ROWS).parquet(str(tmp_path / "in")), sink.merge, str(tmp_path / "state"))
    assert sorted(map(tuple, sink.result().collect())) == [(0, "x", 0), (1, "x", 1), (9, "y", 1)]


def test_progress_goes_on_after_restart(spark, tmp_path):
    path = str(tmp_path / "p.json")
    for number, rows in ((0, 2), (1, 3), (1, 3), (2, 1)):
        ProgressSink(lambda batch, n: None, path, 6, "k = 0")(frame(spark, *[(i, "v", 0) for i in range(rows)]), number)
    said = ProgressSink(None, path, 6, "k = 0").read(spark)
    assert (said["done"], said["found"], said["total"]) == (6, 3, 6)


def size(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_bucket_state(spark, tmp_path):
    state = lambda: BucketState(spark, str(tmp_path), ["k"], "at", ROWS, buckets=16)
    assert state().result().count() == 0 and state().result().columns == ["k", "v", "at"]
    many = [(k, "x" * 50, 0) for k in range(4000)]
    assert state().merge(frame(spark, *many), 0) == 16
    want = {k: (v, at) for k, v, at in many}
    for number, rows in enumerate(([(5, "a", 1), (9000, "b", 1)], [(5, "old", 0), (None, "n", 3)], [(5, "c", 7), (6, "d", 7)]), 1):
        for _ in range(2):  # run again
            written = state().merge(frame(spark, *rows), number)
            assert 1 <= written <= len(rows)
        assert size(tmp_path / "data" / f"v{number}") < size(tmp_path / "data") / 4
        for k, v, at in rows:
            if k not in want or want[k][1] <= at:
                want[k] = (v, at)
    assert {r["k"]: (r["v"], r["at"]) for r in state().result().collect()} == want
    # Each bucket stays in the versions that the last two manifests name.
    kept = {n for m in sorted(tmp_path.glob("manifest-*"))[-2:] for n in json.loads(m.read_text())["buckets"].items()}
    assert {(f.name.split("=")[1], int(f.parent.name[1:])) for f in (tmp_path / "data").glob("v*/bucket_=*")} == kept and len(list(tmp_path.glob("manifest-*"))) == 2
    assert state().merge(frame(spark, (1, "x", 1)).limit(0), 9) == 0 and state().result().count() == len(want)


def test_flush_of_every_third_hit(spark, tmp_path):
    rows = [(k % 5, "hit" if k % 3 else "miss", k) for k in range(40)]
    hits = [r for r in rows if r[1] == "hit"]
    sink = lambda: FlushSink(BucketState(spark, str(tmp_path), ["k"], "at", ROWS, buckets=4), "v = 'hit'")
    last = lambda rows: {k: at for k, _, at in rows}
    seen = 0
    for number, cut in enumerate((1, 2, 9, 10, 31, 40)):
        batch = frame(spark, *rows[seen:cut])
        for _ in range(2):  # run again, as after a restart
            sink()(batch, number)
        seen = cut
        so_far = [r for r in rows[:cut] if r[1] == "hit"]
        assert sink().counts() == {"hits": len(so_far), "flushes": len(so_far) // 3}
        assert {r["k"]: r["at"] for r in sink().state.result().collect()} == last(so_far[: len(so_far) // 3 * 3])
    sink().finish()
    assert {r["k"]: r["at"] for r in sink().state.result().collect()} == last(hits)


def test_progress_in_any_order():
    batches = {n: (n + 1, n % 2) for n in range(12)}
    for seed in range(30):
        draw, held = random.Random(seed), {}
        order = [*batches, *draw.sample(sorted(batches), 5)]
        for n in order if seed == 0 else sorted(order, key=lambda n: n + draw.random() * 3):
            held = json.loads(json.dumps(record(held, n, *batches[n])))
        assert counted(held) == (sum(a for a, _ in batches.values()), sum(b for _, b in batches.values()))
    assert len(held["batches"]) <= 2 and counted({}) == (0, 0)


def test_progress_listener(spark, tmp_path):
    for part in range(3):
        frame(spark, *[(i, "x" if i % 2 else "y", part) for i in range(4)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    listener = ProgressListener(spark, f"{tmp_path}/p.json", 12)
    assert listener.read() is None
    stream = listener.marked(spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), "v = 'x'")
    spark.streams.addListener(listener)
    run_available(stream, lambda batch, n: batch.write.format("noop").mode("overwrite").save(), str(tmp_path / "state"))
    until = time.monotonic() + 30
    while (listener.read() or {"done": 0})["done"] < 12 and time.monotonic() < until:
        time.sleep(0.2)
    spark.streams.removeListener(listener)
    said = listener.read()
    listener.add(1, 4, 2)  # delivered again
    assert (said["done"], said["found"], said["total"]) == (12, 6, 12) and listener.read()["done"] == 12
