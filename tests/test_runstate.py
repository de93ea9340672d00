"""Run-state folds against row-at-a-time Python folds of the same reports."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tabletrust.operators import runstate as R
from tabletrust.plans import REGISTRY
from tabletrust.plans.q_runstate import collector_reports, items, reports

SF = "/root/testdata/sf0.001"


def fold_last_failed(rows):
    """The reference semantics, one report at a time in sequence order."""
    state = {}
    for r in sorted(rows, key=lambda r: (r["seq_ts"], r["seq_id"])):
        if (r["phase"] == "call" and r["outcome"] == "passed") or r["outcome"] == "skipped":
            state.pop(r["node_id"], None)
        elif r["outcome"] == "failed":
            state[r["node_id"]] = True
    return set(state)


def fold_with_collectors(item_rows, collect_rows, children, start=()):
    kids = {}
    for p, c in children:
        kids.setdefault(p, []).append(c)
    events = [(r["seq_ts"], r["seq_id"], "item", r) for r in item_rows]
    events += [(r["seq_ts"], r["seq_id"], "collect", r) for r in collect_rows]
    state = dict.fromkeys(start, True)
    for _, _, kind, r in sorted(events, key=lambda e: (e[0], e[1])):
        node = r["node_id"]
        if kind == "collect":
            if r["outcome"] in ("passed", "skipped"):
                if node in state:
                    state.pop(node)
                    for c in kids.get(node, []):
                        state[c] = True
            else:
                state[node] = True
        else:
            if (r["phase"] == "call" and r["outcome"] == "passed") or r["outcome"] == "skipped":
                state.pop(node, None)
            elif r["outcome"] == "failed":
                state[node] = True
    return set(state)


def test_last_failed_equals_fold(spark):
    rep = reports(spark, SF)
    got = {r["node_id"] for r in R.last_failed(rep).collect()}
    assert got == fold_last_failed(rep.collect())


def test_last_failed_sf001_matches_fixture(spark):
    assert REGISTRY["last_failed"].build(spark, "/root/testdata/sf0.01").count() == 43


def test_collectors_from_a_saved_state(spark):
    from tabletrust.plans.q_runstate import from_saved_state

    start, after, collect, children = from_saved_state(reports(spark, SF))
    got = {r["node_id"] for r in R.expand_collectors(after, collect, children, start=start).collect()}
    want = fold_with_collectors(after.collect(), collect.collect(), [tuple(r) for r in children.collect()], [r[0] for r in start.collect()])
    assert got == want and want


def test_collectors_with_silent_parents_and_cycles(spark):
    import pytest

    t = datetime(2024, 1, 1)
    schema = "node_id string, seq_ts timestamp, seq_id bigint, outcome string"
    item = spark.createDataFrame([], "node_id string, seq_ts timestamp, seq_id bigint, phase string, outcome string")
    tree = spark.createDataFrame([("root", "mod"), ("mod", "case")], "parent string, child string")
    failed = spark.createDataFrame([("mod", t, 1, "failed")], schema)
    # The parent never reports: the module is a root.
    assert [r[0] for r in R.expand_collectors(item, failed, tree).collect()] == ["mod"]
    passed = spark.createDataFrame([("mod", t, 1, "passed")], schema)
    start = spark.createDataFrame([("mod",), ("other",)], "node_id string")
    assert sorted(r[0] for r in R.expand_collectors(item, passed, tree, start=start).collect()) == ["case", "other"]
    two = spark.createDataFrame([("a", t, 1, "failed"), ("b", t, 2, "failed")], schema)
    for edges in ([("a", "b"), ("b", "a")], [("a", "a")], [("mod", "a"), ("a", "b"), ("b", "b")]):
        with pytest.raises(ValueError):
            R.expand_collectors(item, two, spark.createDataFrame(edges, "parent string, child string")).collect()


def test_collectors_equal_fold_on_events(spark):
    rep = reports(spark, SF)
    collect, children = collector_reports(rep)
    got = {r["node_id"] for r in R.expand_collectors(rep, collect, children).collect()}
    want = fold_with_collectors(rep.collect(), collect.collect(), [tuple(r) for r in children.collect()])
    assert got == want


def test_collectors_random_depth3(spark):
    rng = random.Random(7)
    t0 = datetime(2024, 1, 1)
    for trial in range(3):
        pk = ["p0", "p1"]
        mods = {p: [f"{p}/m{i}" for i in range(2)] for p in pk}
        cases = {m: [f"{m}::c{i}" for i in range(3)] for ms in mods.values() for m in ms}
        children = [(p, m) for p, ms in mods.items() for m in ms] + [(m, c) for m, cs in cases.items() for c in cs]
        item_rows, collect_rows, sid = [], [], 0
        for day in range(6):
            base = t0 + timedelta(days=day)
            for p in pk:
                collect_rows.append(dict(node_id=p, seq_ts=base, seq_id=-2, outcome=rng.choice(["failed", "passed", "passed"])))
            for ms in mods.values():
                for m in ms:
                    collect_rows.append(dict(node_id=m, seq_ts=base, seq_id=-1, outcome=rng.choice(["failed", "passed", "passed"])))
            for cs in cases.values():
                for c in cs:
                    if rng.random() < 0.5:
                        sid += 1
                        item_rows.append(dict(node_id=c, seq_ts=base + timedelta(seconds=sid), seq_id=sid,
                                              phase=rng.choice(["setup", "call"]),
                                              outcome=rng.choice(["failed", "passed", "skipped"])))
        it = spark.createDataFrame(item_rows, "node_id string, seq_ts timestamp, seq_id bigint, phase string, outcome string")
        co = spark.createDataFrame(collect_rows, "node_id string, seq_ts timestamp, seq_id bigint, outcome string")
        ch = spark.createDataFrame(children, "parent string, child string")
        got = {r["node_id"] for r in R.expand_collectors(it, co, ch).collect()}
        assert got == fold_with_collectors(item_rows, collect_rows, children), trial


def test_failed_first_order(spark):
    out = REGISTRY["failed_first"].build(spark, SF).orderBy("run_order").collect()
    flags = [r["failed"] for r in out]
    assert flags == sorted(flags, reverse=True)
    n_failed = sum(flags)
    assert [r["pos"] for r in out[:n_failed]] == sorted(r["pos"] for r in out[:n_failed])
    assert [r["run_order"] for r in out] == list(range(1, len(out) + 1))


def test_new_first_dedup_keeps_first_position_last_data(spark):
    rows = [("a", datetime(2024, 1, 1), 1), ("b", datetime(2024, 1, 3), 2), ("a", datetime(2024, 1, 5), 3),
            ("c", datetime(2024, 1, 2), 4)]
    it = spark.createDataFrame(rows, "node_id string, mtime timestamp, pos bigint")
    known = spark.createDataFrame([("c",)], "node_id string")
    out = [(r["node_id"], r["is_new"], r["pos"]) for r in R.new_first(it, known).collect()]
    assert out == [("a", True, 1), ("b", True, 2), ("c", False, 4)]


def test_select_known_fallbacks(spark):
    it = spark.createDataFrame([("x",), ("y",)], "node_id string")
    none = spark.createDataFrame([], "node_id string")
    other = spark.createDataFrame([("z",)], "node_id string")
    assert R.select_known(it, none).count() == 2
    assert R.select_known(it, none, no_failures="none").count() == 0
    assert R.select_known(it, other).count() == 2
    assert R.select_known(it, spark.createDataFrame([("y",)], "node_id string")).count() == 1


def test_semi_plus_anti_is_everything(spark):
    rep = reports(spark, SF)
    it = items(rep)
    f = R.last_failed(rep)
    assert R.select_known(it, f).count() + R.deselect_known(it, f).count() == it.count()


def test_status_line_texts(spark):
    it = spark.createDataFrame([("a", "f1.py"), ("b", "f2.py")], "node_id string, path string")
    one = spark.createDataFrame([("a",)], "node_id string")
    files = spark.createDataFrame([("f2.py", True)], "path string, skipped boolean")
    assert R.status_line(it, one, files).first()["status"] == "rerun previous 1 failure (skipped 1 file)"
    none = spark.createDataFrame([], "node_id string")
    assert R.status_line(it, none).first()["status"] == "no previously failed tests, not deselecting items."
    far = spark.createDataFrame([("q",), ("r",)], "node_id string")
    assert R.status_line(it, far).first()["status"] == "2 known failures not in selected tests"


def test_ancestor_paths(spark):
    df = spark.createDataFrame([("a/b/c.py",)], "p string")
    assert df.select(R.ancestor_paths(F.col("p"))).first()[0] == ["a", "a/b", "a/b/c.py"]


def test_stream_equals_batch(spark):
    sf = "/root/testdata/sf0.001"
    a = {r[0] for r in REGISTRY["last_failed_stream"].build(spark, sf).collect()}
    b = {r[0] for r in REGISTRY["last_failed"].build(spark, sf).collect()}
    assert a == b


def test_select_in_files_rules(spark):
    items = spark.createDataFrame([
        ("a/f1.py::t1", "a/f1.py"), ("a/f1.py::t2", "a/f1.py"),      # clean: after the failing files of its folder
        ("a/f2.py::t1", "a/f2.py"), ("a/f2.py::t2", "a/f2.py"),      # first hit: only the failure
        ("a/f0.py::t1", "a/f0.py"),                                  # its known failure is gone: whole, before the hit
        ("a/f3.py::t1", "a/f3.py"),                                  # not among failing paths: skipped
        ("0/f5.py::t1", "0/f5.py"),                                  # a clean folder comes after the failing ones
        ("b/f4.py::t1", "b/f4.py"), ("b/f4.py::t2", "b/f4.py"),      # failing path + given path
    ], "node_id string, path string")
    failing = spark.createDataFrame([("a/f2.py::t2",), ("b/f4.py::t1",), ("a/f0.py::gone",)], "node_id string")
    lf = R.failing_paths(failing, R.path_inventory(items))
    kept, files = R.select_in_files(items, failing, lf, init_paths=["b/f4.py"])
    got = {r["node_id"]: r["kept"] for r in kept.collect()}
    assert got == {"a/f1.py::t1": False, "a/f1.py::t2": False, "a/f2.py::t1": False, "a/f2.py::t2": True, "a/f0.py::t1": True,
                   "a/f3.py::t1": False, "0/f5.py::t1": False, "b/f4.py::t1": True, "b/f4.py::t2": True}
    assert {r["path"]: r["skipped"] for r in files.collect()} == {
        "a/f1.py": True, "a/f2.py": False, "a/f0.py": False, "a/f3.py": True, "0/f5.py": True, "b/f4.py": False}
    # Without any known failure everything is kept.
    kept, files = R.select_in_files(items, failing.limit(0), lf.limit(0))
    assert kept.where("not kept").isEmpty() and files.where("skipped").isEmpty()
    status = R.status_line(items, spark.createDataFrame([("a/f0.py::gone",)], "node_id string"), spark.createDataFrame([("x", True)], "path string, skipped boolean"))
    assert status.first()["status"] == "1 known failures not in selected tests (skipped 1 file)"


def test_stream_publishes_only_changed_failing_sets(spark):
    from tabletrust.session import scratch_path
    from tabletrust.streaming import runstate_stream as ST

    path = scratch_path(spark, "publish-test")
    batches = [
        [("x", False)],                  # the first set is published, though empty
        [("a", True), ("c", True)],      # a and c fail: publish
        [("a", True)],                   # still failing: no publish
        [("a", False), ("b", True)],     # the set changes: publish
        [("z", False)],                  # nothing that was failing: no publish
        [("b", False), ("c", False)],    # all pass: an empty set is published
    ]
    frames = [spark.createDataFrame(rows, "node_id string, failing boolean") for rows in batches]
    want = [[], ["a", "c"], ["a", "c"], ["b", "c"], ["b", "c"], []]
    assert ST.published_set(spark, path) is None
    for i, frame in enumerate(frames):
        assert ST.publish_changes(spark, frame, i, path) is (i not in (2, 4))
        assert sorted(r[0] for r in ST.published_set(spark, path).collect()) == want[i]
        # A repeated batch changes nothing.
        assert ST.publish_changes(spark, frame, i, path) is False
        assert sorted(r[0] for r in ST.published_set(spark, path).collect()) == want[i]


def test_stream_in_many_batches_and_any_order(spark, tmp_path):
    from pyspark.sql import functions as F
    from tabletrust.session import scratch_path
    from tabletrust.streaming import runstate_stream as ST

    rep = reports(spark, SF)
    src, base = str(tmp_path / "reports"), scratch_path(spark, "many-batches")
    rep.repartition(6, F.xxhash64("seq_id")).write.parquet(src)
    stream = spark.readStream.schema(rep.schema).option("maxFilesPerTrigger", 1).parquet(src)
    want = {r[0] for r in R.last_failed(rep).collect()}
    ST.last_failed_stream(spark, stream, f"{base}/p", f"{base}/c1").awaitTermination()
    assert {r[0] for r in ST.published_set(spark, f"{base}/p").collect()} == want
    ST.last_failed_stateful(stream, f"{base}/x", f"{base}/c2").awaitTermination()
    got = ST.current_from_changes(spark.read.parquet(f"{base}/x")).where("failing")
    assert {r[0] for r in got.collect()} == want


class _FakeState:
    """Stand-in for GroupState: enough to drive the fold function."""

    def __init__(self, value=None, timed_out=False):
        self.value, self.hasTimedOut, self.timeout = value, timed_out, None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def test_state_store_fold_function():
    import pandas as pd

    from tabletrust.streaming.runstate_stream import _fold_node

    fold = _fold_node(ttl_ms=60_000)
    pdf = pd.DataFrame({"node_id": ["n"] * 3, "seq_ts": pd.to_datetime(["2024-01-01"] * 3), "seq_id": [3, 1, 2],
                        "phase": ["call", "call", "setup"], "outcome": ["failed", "passed", "failed"]})
    st = _FakeState()
    out = list(fold(("n",), iter([pdf]), st))
    assert len(out) == 1 and bool(out[0]["failing"].iloc[0]) and st.value[1] == 3 and st.timeout == 60_000
    # an older report changes nothing and emits nothing
    older = pdf.assign(seq_id=[0, 0, 0], outcome=["passed"] * 3)
    assert list(fold(("n",), iter([older]), st)) == [] and st.value[2] is True
    # expiry forgets the node and records it as not failing after its last report
    gone = list(fold(("n",), iter([]), _FakeState(st.value, timed_out=True)))
    assert bool(gone[0]["failing"].iloc[0]) is False and gone[0]["ts_us"].iloc[0] == st.value[0] + 1


def test_prune_files_and_known_keys(spark):
    items = spark.createDataFrame([("a/f1.py::t", "a/f1.py"), ("a/f2.py::t", "a/f2.py"), ("a/f3.py::t", "a/f3.py")],
                                  "node_id string, path string")
    failing = spark.createDataFrame([("a/f2.py::t",)], "node_id string")
    lf = R.failing_paths(failing, R.path_inventory(items))
    files, count = R.prune_files(items, failing, lf)
    assert sorted(r[0] for r in files.collect()) == ["a/f1.py", "a/f3.py"] and count.first()[0] == 2
    known = R.known_keys(spark.createDataFrame([("b",), ("a",)], "node_id string"), items.select("node_id"))
    assert [r[0] for r in known.collect()] == ["a", "a/f1.py::t", "a/f2.py::t", "a/f3.py::t", "b"]


def test_collectors_with_per_report_children(spark):
    rng = random.Random(3)
    t0 = datetime(2024, 1, 1)
    pk = ["p0", "p1"]
    mods = {p: [f"{p}/m{i}" for i in range(3)] for p in pk}
    cases = {m: [f"{m}::c{i}" for i in range(4)] for ms in mods.values() for m in ms}
    item_rows, collect_rows, sid = [], [], 0
    for day in range(8):
        base = t0 + timedelta(days=day)
        for p in pk:   # what a collection yields changes from run to run
            yielded = [m for m in mods[p] if rng.random() < 0.7]
            collect_rows.append(dict(node_id=p, seq_ts=base, seq_id=-2, outcome=rng.choice(["failed", "passed"]),
                                     children=yielded))
        for ms in mods.values():
            for m in ms:
                yielded = [c for c in cases[m] if rng.random() < 0.7]
                collect_rows.append(dict(node_id=m, seq_ts=base, seq_id=-1, outcome=rng.choice(["failed", "passed", "passed"]),
                                         children=yielded))
        for cs in cases.values():
            for c in cs:
                if rng.random() < 0.4:
                    sid += 1
                    item_rows.append(dict(node_id=c, seq_ts=base + timedelta(seconds=sid), seq_id=sid,
                                          phase="call", outcome=rng.choice(["failed", "passed", "skipped"])))

    def fold():
        events = [(r["seq_ts"], r["seq_id"], "item", r) for r in item_rows]
        events += [(r["seq_ts"], r["seq_id"], "collect", r) for r in collect_rows]
        state = {}
        for _, _, kind, r in sorted(events, key=lambda e: (e[0], e[1])):
            n = r["node_id"]
            if kind == "collect":
                if r["outcome"] == "passed":
                    if n in state:
                        state.pop(n)
                        state.update((c, True) for c in r["children"])
                else:
                    state[n] = True
            elif r["outcome"] == "passed" or r["outcome"] == "skipped":
                state.pop(n, None)
            else:
                state[n] = True
        return set(state)

    it = spark.createDataFrame(item_rows, "node_id string, seq_ts timestamp, seq_id bigint, phase string, outcome string")
    co = spark.createDataFrame(collect_rows, "node_id string, seq_ts timestamp, seq_id bigint, outcome string, children array<string>")
    got = {r["node_id"] for r in R.expand_collectors(it, co).collect()}
    assert got == fold()


def test_select_in_files_keeps_collectors(spark):
    items = spark.createDataFrame([("f.py::C", "f.py", True), ("f.py::C::t1", "f.py", False), ("f.py::C::t2", "f.py", False)],
                                  "node_id string, path string, is_collector boolean")
    failing = spark.createDataFrame([("f.py::C::t2",)], "node_id string")
    lf = R.failing_paths(failing, R.path_inventory(items))
    kept, _ = R.select_in_files(items, failing, lf, collector="is_collector")
    assert {r["node_id"]: r["kept"] for r in kept.collect()} == {"f.py::C": True, "f.py::C::t1": False, "f.py::C::t2": True}


def test_nth_error(spark):
    t = datetime(2024, 1, 1)
    ev = spark.createDataFrame([("a", t, 3, "e3"), ("a", t, 1, "e1"), ("a", t, 2, "e2"), ("b", t, 5, "x"), ("a", t, 4, None)],
                               "node_id string, seq_ts timestamp, seq_id bigint, error string")
    assert sorted(tuple(r) for r in R.nth_error(ev, 2).collect()) == [("a", "e2")]
    assert sorted(tuple(r) for r in R.first_error(ev).select("node_id", "first_error").collect()) == [("a", "e1"), ("b", "x")]


def test_first_seen_stream_with_watermark(spark):
    from tabletrust.plans.q_stream import report_stream
    from tabletrust.session import scratch_path
    from tabletrust.streaming import runstate_stream as ST

    base, stream = scratch_path(spark, "seen-wm"), report_stream(spark, SF)
    q = ST.first_seen_stream(stream, f"{base}/seen", f"{base}/ckpt", watermark="2 days")
    q.awaitTermination()
    seen = spark.read.parquet(f"{base}/seen").select("node_id")
    # bounded state may let a node re-appear after the watermark passes, but none is lost
    assert {r[0] for r in seen.distinct().collect()} == {r[0] for r in reports(spark, SF).select("node_id").distinct().collect()}


def test_stateful_stream_with_ttl_runs(spark):
    from tabletrust.plans.q_stream import report_stream
    from tabletrust.session import scratch_path
    from tabletrust.streaming import runstate_stream as ST

    import pytest

    base, stream = scratch_path(spark, "stateful-ttl"), report_stream(spark, SF)
    with pytest.raises(ValueError):
        ST.last_failed_stateful(stream, f"{base}/x", f"{base}/y", ttl_ms=1000)
    import time

    want_rows = reports(spark, SF).count()
    q = ST.last_failed_stateful(stream, f"{base}/changes", f"{base}/ckpt", ttl_ms=3_600_000, available_now=False)
    try:  # timeouts keep a running query busy with no-data batches: wait for the input, then stop
        deadline = time.time() + 90
        while time.time() < deadline and sum(p["numInputRows"] for p in q.recentProgress) < want_rows:
            time.sleep(1)
        time.sleep(2)  # let the batch that read the last rows commit
    finally:
        q.stop()
    got = {r[0] for r in ST.current_from_changes(spark.read.parquet(f"{base}/changes")).where("failing").collect()}
    assert got == {r[0] for r in R.last_failed(reports(spark, SF)).collect()}


def test_paths_first_function_and_status_variants(spark):
    files = spark.createDataFrame([("a.py", 1), ("b.py", 2), ("c.py", 3)], "path string, pos int")
    hits = spark.createDataFrame([("c.py",)], "path string")
    assert [r["path"] for r in R.paths_first(files, hits).collect()] == ["c.py", "a.py", "b.py"]
    it = spark.createDataFrame([("a", "f1.py"), ("b", "f1.py")], "node_id string, path string")
    two = spark.createDataFrame([("a",), ("b",)], "node_id string")
    none = spark.createDataFrame([], "node_id string")
    assert R.status_line(it, two, failed_first_mode=True).first()["status"] == "rerun previous 2 failures first"
    assert R.status_line(it, none, no_failures="none").first()["status"] == \
        "no previously failed tests, deselecting all items."


def test_a_new_checkpoint_goes_on_from_the_published_set(spark):
    from tabletrust.session import scratch_path
    from tabletrust.streaming import runstate_stream as ST

    path = scratch_path(spark, "publish-again")
    frame = lambda *rows: spark.createDataFrame(list(rows), "node_id string, failing boolean")
    nodes = lambda: sorted(r[0] for r in ST.published_set(spark, path).collect())
    assert ST.publish_changes(spark, frame(("n1", True)), 0, path, "first") and ST.publish_changes(spark, frame(("n2", True)), 5, path, "first")
    assert not ST.publish_changes(spark, frame(("n2", True)), 5, path, "first")
    assert ST.publish_changes(spark, frame(("n3", True)), 0, path, "second") and nodes() == ["n1", "n2", "n3"]
    assert not ST.publish_changes(spark, frame(("n3", False)), 0, path, "second")  # repeated
    assert ST.publish_changes(spark, frame(("n1", False), ("n4", True)), 1, path, "second") and nodes() == ["n2", "n3", "n4"]
    assert not ST.publish_changes(spark, frame(("n1", False)), 2, path, "second") and nodes() == ["n2", "n3", "n4"]
