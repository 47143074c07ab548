"""Routing between the two exact ways, where intermediates are written, and the command line."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, write_lines_file
from mutualis import session
from mutualis.operators import mutual, mutual_counts, prepare_graph
from mutualis.session import checkpoint_dir, materialize
from test_fixtures_graph import GRAPH, PROFILES
from test_properties import brute_force


def _hub_graph(spark):
    rows = []
    for v in range(120):
        rows += [(1000, v), (v, 1000)]           # one hub linked both ways to every node
        rows += [(v, (v + 1) % 120), ((v + 1) % 120, v), (v, (v + 2) % 120)]
    return rows, spark.createDataFrame(rows, "src bigint, dst bigint")


def test_balance_and_hub_limit_route_pairs(spark):
    rows, df = _hub_graph(spark)
    g = prepare_graph(df)
    assert g.largest == 120
    assert g.pairs.where((F.col("id1") == 1000) | (F.col("id2") == 1000)).count() == 120
    # Every hub pair is unbalanced (120 vs about 4), so every way gives the brute-force answer; the
    # arrays way cuts the hub's list into 24 parts.
    for kw in ({}, {"balance": 1000.0}, {"hub_degree": 5}, {"strategy": "probe"}, {"strategy": "arrays"},
               {"strategy": "arrays", "hub_degree": 5}):
        got = {tuple(r) for r in mutual_counts(g, **kw).collect()}
        assert got == brute_force(rows), kw
    g.release(spark)


def test_intermediates_live_in_the_checkpoint_folder(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    out = materialize(df, "probe_location")
    files = out.inputFiles()
    base = checkpoint_dir(spark).replace("file:", "")
    assert files and all(base in f for f in files)
    assert out.count() == 10


def test_command_line_friends_job(tmp_path):
    users = write_lines_file(tmp_path, "users.txt", PROFILES)
    soc = write_lines_file(tmp_path, "friends.txt", GRAPH)
    out = tmp_path / "out"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=root)
    res = subprocess.run([sys.executable, "-m", "mutualis", "friends", "--users", users, "--friends", soc,
                          "--out", str(out), "--k", "1"], env=env, capture_output=True, text=True,
                         timeout=300, cwd=str(tmp_path))
    assert res.returncode == 0, res.stderr[-2000:]
    lines = []
    for f in sorted((out / "top_pairs").glob("part-*")):
        lines += f.read_text().splitlines()
    assert lines == ["2\tAnn\tLee\t1 First St\tBob\tKim\t2 Second St"]


def test_empty_and_pairless_graphs(spark):
    empty = spark.createDataFrame([], "src bigint, dst bigint")
    assert mutual_counts(empty).collect() == []
    assert mutual_counts(empty, keep_zero=True).collect() == []
    one_sided = spark.createDataFrame([(1, 2), (3, 4), (5, 5)], "src bigint, dst bigint")
    assert mutual_counts(one_sided).collect() == []


def test_materialize_observes_metrics_in_the_same_write(spark):
    df = spark.range(100)
    out, seen = materialize(df, "observed", metrics={"n": F.count(F.lit(1)), "top": F.max("id")})
    assert seen == {"n": 100, "top": 99}
    assert out.count() == 100


def _exists(spark, folder):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_friends_job_leaves_no_intermediates(spark, tmp_path, monkeypatch):
    from mutualis import session
    from mutualis.plans.jobs import friends_job
    users = write_lines_file(tmp_path, "users.txt", PROFILES)
    soc = write_lines_file(tmp_path, "friends.txt", GRAPH)
    before, seen, real = set(session._LIVE), [], session.scratch_path

    def spy(*args):
        seen.append(real(*args).rpartition("/")[0])
        return f"{seen[-1]}/x"
    monkeypatch.setattr(session, "scratch_path", spy)
    friends_job(spark, users, soc, str(tmp_path / "out"), k=2)
    assert seen and not any(_exists(spark, f) for f in seen)
    assert session._LIVE == before
    assert (tmp_path / "out" / "top_pairs").exists()


def test_interleaved_scopes_keep_each_others_results(spark):
    from contextlib import ExitStack
    first, second = ExitStack(), ExitStack()
    first.enter_context(session.scratch_scope(spark))
    a = materialize(spark.range(5), "a")
    second.enter_context(session.scratch_scope(spark))
    b = materialize(spark.range(6), "b")
    first.close()
    assert b.count() == 6 and not _exists(spark, a.inputFiles()[0].rpartition("/")[0])
    c = materialize(spark.range(7), "c")
    assert c.count() == 7
    second.close()
    assert not any(_exists(spark, x.inputFiles()[0]) for x in (b, c))


def test_two_jobs_in_threads(spark, tmp_path):
    import threading

    from mutualis.plans.jobs import friends_job
    users = write_lines_file(tmp_path, "users.txt", PROFILES)
    soc = write_lines_file(tmp_path, "friends.txt", GRAPH)
    failed = []

    def job(i):
        try:
            friends_job(spark, users, soc, str(tmp_path / f"out{i}"), k=1)
        except Exception as e:
            failed.append(e)
    threads = [threading.Thread(target=job, args=(i,)) for i in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed


def test_text_forms_and_graphs_are_made_anew_after_release(spark):
    from mutualis.plans import QUERIES, catalog
    n = QUERIES["src_text_lines"](spark, SF_SMALL).count()
    m = QUERIES["q1_from_text"](spark, SF_SMALL).count()
    session.drop_scratch(spark)
    assert QUERIES["src_text_lines"](spark, SF_SMALL).count() == n
    assert catalog.release(spark) > 0
    assert QUERIES["src_text_lines"](spark, SF_SMALL).count() == n
    assert QUERIES["q1_from_text"](spark, SF_SMALL).count() == m


def test_no_shared_folder_is_an_error_off_a_local_master():
    class Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

        def set(self, k, v):
            self[k] = v

    class Remote:  # a session with no local SparkContext and no checkpoint setting
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("no context")

    class Cluster(Remote):
        class sparkContext:
            master = "local-cluster[2,1,1024]"

            @staticmethod
            def getCheckpointDir():
                return None

    for kind in (Remote, Cluster):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.checkpoint_dir(kind())
    r = Remote()
    r.conf = Conf({"spark.checkpoint.dir": "hdfs://x/y"})
    assert session.checkpoint_dir(r) == "hdfs://x/y"
    assert session.app_id(r) == "app"


def test_entry_file_works_from_another_directory(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(root, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").getOrCreate()
print("entry", m.entry(s).count())
print("udf", m.queries()["udf_scalar_float"](s, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True,
                         text=True, timeout=300)
    assert res.returncode == 0, res.stderr[-2000:]
    assert "entry 10" in res.stdout and "udf 200" in res.stdout


def _closed(rows):
    return sorted({(a, b) for a, b in rows} | {(b, a) for a, b in rows})


def test_closed_graph_lists_only_higher_neighbours(spark):
    """Every pair with a hub was expanded by its whole short list; a hub's own list is now empty."""
    rows = _closed([(1000 + h, v) for h in range(3) for v in range(120)] + [(v, (v + 1) % 120) for v in range(120)])
    g = prepare_graph(spark.createDataFrame(rows, "src bigint, dst bigint"))
    pairs = g.pairs.count()
    assert g.largest == 120 and g.longest ** 2 <= 2 * pairs
    d = {r["u"]: r["d"] for r in g.higher.collect()}
    assert not set(d) & {1000, 1001, 1002} and sum(d.values()) == pairs
    sent = mutual._triangles_by_arrays(g, g.longest, 256)
    assert sent.count() == 3 * 120  # each triangle once
    for kw in ({}, {"hub_degree": 2}, {"hub_degree": 4}, {"strategy": "arrays", "hub_degree": 1}, {"strategy": "probe"}):
        assert {tuple(r) for r in mutual_counts(g, **kw).collect()} == brute_force(rows), kw
    g.release(spark)


@pytest.mark.parametrize("one_way", [False, True])
def test_dense_graph_every_way(spark, one_way):
    import random
    rnd = random.Random(11)
    rows = _closed([(a, b) for a, b in ((rnd.randrange(-20, 20), rnd.randrange(-20, 20)) for _ in range(300)) if a != b])
    rows += [(rows[0][0], 99)] * one_way
    g = prepare_graph(spark.createDataFrame(rows * 2, "src bigint, dst bigint"))
    assert (g.higher is None) == one_way
    for kw in ({}, {"hub_degree": 3}, {"hub_degree": 8}, {"strategy": "arrays", "hub_degree": 3}, {"strategy": "probe"}):
        assert {tuple(r) for r in mutual_counts(g, **kw).collect()} == brute_force(rows), kw
    g.release(spark)


@pytest.mark.parametrize("kw", [{}, {"hub_degree": 4}, {"strategy": "arrays", "hub_degree": 3}, {"strategy": "probe"}])
def test_closed_graph_in_rounds(spark, monkeypatch, kw):
    """All triangles were looked for in one job: what it sent lay on disk at once, many times the edges."""
    import random
    rnd = random.Random(7)
    rows = _closed([(a, b) for a, b in ((rnd.randrange(60), rnd.randrange(60)) for _ in range(700)) if a != b])
    g = prepare_graph(spark.createDataFrame(rows, "src bigint, dst bigint"))
    assert g.size == len(rows) // 2 and g.wedges == sum(r["d"] * (r["d"] - 1) // 2 for r in g.higher.collect())
    seen, real = [], mutual.materialize

    def spy(df, name, *args, **more):
        seen.append((name, spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)))
        return real(df, name, *args, **more)
    monkeypatch.setattr(mutual, "materialize", spy)
    monkeypatch.setattr(mutual, "ONE_ROUND", 16)
    held = len(g.scratch.folders)
    out = mutual_counts(g, **kw)
    assert seen.count(("counts", "true")) >= 2  # rounds, whose shuffle files go
    assert len(g.scratch.folders) == held + 1  # the last counts
    assert {tuple(r) for r in out.collect()} == brute_force(rows)
    assert {tuple(r) for r in mutual_counts(g, keep_zero=True, **kw).where("n > 0").collect()} == brute_force(rows)
    monkeypatch.setattr(mutual, "ROUND_IDS", 1 << 20)  # one round, in the plan
    seen.clear()
    assert {tuple(r) for r in mutual_counts(g, **kw).collect()} == brute_force(rows)
    assert "counts" not in {name for name, _ in seen}
    g.release(spark)


def test_preparing_a_graph_keeps_no_shuffle_files(spark, monkeypatch):
    """They stayed until the driver collected its garbage."""
    seen, real = [], mutual.materialize
    monkeypatch.setattr(mutual, "materialize", lambda *args, **kw: seen.append(
        spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)) or real(*args, **kw))
    prepare_graph(spark.createDataFrame([(1, 2), (2, 1)], "src bigint, dst bigint")).release(spark)
    assert seen and set(seen) == {"true"}


@pytest.mark.parametrize("one_way", [False, True])
def test_many_links_are_written_in_rounds(spark, monkeypatch, one_way):
    """The member edges' two exchanges, and those of the pairs, lay on disk at once."""
    rows = _closed([(a, (a * k + k) % 50) for a in range(50) for k in range(1, 9) if a != (a * k + k) % 50]) + [(3, 99)] * one_way
    df = spark.createDataFrame(rows, "src bigint, dst bigint")
    names, real = [], mutual.materialize
    monkeypatch.setattr(mutual, "materialize", lambda df, name, *args, **kw: names.append(name) or real(df, name, *args, **kw))
    monkeypatch.setattr(mutual, "MANY_LINKS", 10)
    g = prepare_graph(df)
    assert names.count("pairs") == mutual.LINK_ROUNDS and (g.higher is None) == one_way
    assert sorted(tuple(r) for r in g.edges.collect()) == sorted(set(rows)) and g.pairs.count() == g.size
    for kw in ({}, {"strategy": "probe"}):
        assert {tuple(r) for r in mutual_counts(g, **kw).collect()} == brute_force(rows), kw
    g.release(spark)
