"""The end-to-end text jobs on the FIXTURES.md inputs: output lines as the original jobs write them."""

import glob
import os

from conftest import write_lines_file
from mutualis.plans.jobs import friends_job, ratings_job
from test_fixtures_graph import GRAPH, PROFILES
from test_fixtures_ratings import BUSINESS, REVIEWS


def read_dir(path):
    out = []
    for f in sorted(glob.glob(os.path.join(path, "part-*"))):
        with open(f) as fh:
            out += [line.rstrip("\n") for line in fh]
    return out


def test_friends_job(spark, tmp_path):
    users = write_lines_file(tmp_path, "users.txt", PROFILES + ["4,Di,Ox,4 Fourth St,T,S,4,US,di,x"])
    soc = write_lines_file(tmp_path, "friends.txt", GRAPH)
    out = friends_job(spark, users, soc, str(tmp_path / "out"), k=3)
    q1 = sorted(read_dir(out["mutual_friends"]))
    assert q1 == sorted(["1, 2\t2", "1, 3\t1", "1, 4\t2", "2, 3\t1", "2, 4\t2", "9, 10\t1", "9, 11\t1",
                         "10, 11\t1"])
    q2 = read_dir(out["top_pairs"])
    assert q2 == ["2\tAnn\tLee\t1 First St\tBob\tKim\t2 Second St",
                  "2\tAnn\tLee\t1 First St\tDi\tOx\t4 Fourth St",
                  "2\tBob\tKim\t2 Second St\tDi\tOx\t4 Fourth St"]


def test_ratings_job(spark, tmp_path):
    b = write_lines_file(tmp_path, "businesses.txt", BUSINESS)
    r = write_lines_file(tmp_path, "reviews.txt", REVIEWS)
    out = ratings_job(spark, b, r, str(tmp_path / "out"))
    assert sorted(read_dir(out["ratings"])) == ["u1\t4.0", "u1\t4.0", "u2\t5.0"]
    assert read_dir(out["top_rated"]) == [
        "b1\t1 Main, Stanford, CA 94305\tList(Food)\t4.25",
        "b2\t2 Elm, Stanford, CA 94305\tList(Bar)\t4.0",
        "b3\t3 Oak, Palo Alto, CA\tList(Cafe)\t2.0",
    ]


def test_ratings_job_key_order_over_distinct_lines(spark, tmp_path):
    b = write_lines_file(tmp_path, "businesses.txt", BUSINESS)
    r = write_lines_file(tmp_path, "reviews.txt", REVIEWS)
    out = ratings_job(spark, b, r, str(tmp_path / "out2"), per_business=False, dedup=True, by="key")
    assert sorted(read_dir(out["ratings"])) == ["u1\t4.0", "u2\t5.0"]
    top = read_dir(out["top_rated"])
    assert [line.split("\t")[0] for line in top] == ["b3", "b2", "b1"]
    assert top[2].startswith("b1\t") and abs(float(top[2].split("\t")[3]) - 13 / 3) < 1e-12
