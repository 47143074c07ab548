"""End-to-end jobs on the original text inputs: each pair of questions as one lazy plan.

``friends_job``: user profiles + adjacency lines → Q1 lines (``id1, id2<TAB>n``) and Q2 lines
(``n`` and both members' first name, last name, address, tab-separated).
``ratings_job``: business + review records → Q3 lines (``userid<TAB>stars``) and Q4 lines
(``businessid<TAB>address<TAB>categories<TAB>mean``).

Outputs are text directories (one part file per task). Nothing passes through the driver; the
intermediates read more than once (the prepared graph, the pair counts behind Q1 and Q2) are written
once to the shared checkpoint folder and deleted when the outputs are written.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..functions import pair_line, tab_line
from ..operators import (
    edges_from_adjacency, mutual_counts, prepare_graph, ratings_for, top_pairs_with_profiles, top_rated,
)
from ..operators.mutual import DEFAULT_BALANCE, DEFAULT_HUB_DEGREE, STRATEGIES
from ..operators.ratings import MATCH
from ..session import apply_tuning, materialize, scratch_scope
from ..sinks import write_lines
from ..sources import parse_adjacency, parse_businesses, parse_profiles, parse_reviews, read_lines
from ..sources.schemas import DEFAULT_ADDRESS_PATTERN, DEFAULT_TOP_K

Q2_FIELDS = ["n", "a_first", "a_last", "a_address", "b_first", "b_last", "b_address"]


def friends_job(spark: SparkSession, users_path: str, friends_path: str, out_dir: str,
                k: int = DEFAULT_TOP_K, how: str = "inner", strategy: str = "auto",
                hub_degree: int = DEFAULT_HUB_DEGREE, balance: float = DEFAULT_BALANCE,
                keep_zero: bool = False, null_text: str = "", mode: str = "errorifexists") -> dict[str, str]:
    """Q1 and Q2. Returns the two output directories; the intermediates are deleted after.

    ``strategy``, ``hub_degree``, ``balance`` choose how pairs are counted (the result is the same);
    ``keep_zero`` also writes pairs that share nobody; ``null_text`` stands for a null field.
    """
    profiles = parse_profiles(read_lines(spark, users_path))
    edges = edges_from_adjacency(parse_adjacency(read_lines(spark, friends_path)))
    out = {"mutual_friends": f"{out_dir}/mutual_friends", "top_pairs": f"{out_dir}/top_pairs"}
    with scratch_scope(spark) as scratch:
        graph = prepare_graph(edges)
        scratch.folders += graph.scratch.folders
        counts = materialize(mutual_counts(graph, strategy, hub_degree, balance, keep_zero), "mutual_counts")
        write_lines(counts, out["mutual_friends"], line=pair_line("id1", "id2", "n", null_text=null_text), mode=mode)
        top = top_pairs_with_profiles(counts.where("n > 0"), profiles, k=k, how=how)
        write_lines(top.coalesce(1), out["top_pairs"], line=tab_line(*Q2_FIELDS, null_text=null_text), mode=mode)
    return out


def ratings_job(spark: SparkSession, business_path: str, review_path: str, out_dir: str,
                pattern: str = DEFAULT_ADDRESS_PATTERN, k: int = DEFAULT_TOP_K,
                per_business: bool = True, dedup: bool = False, by: str = "mean", match: str = "contains",
                null_text: str = "", mode: str = "errorifexists") -> dict[str, str]:
    """Q3 and Q4. Returns the two output directories. ``match``: the address test (F4 or F5)."""
    businesses = parse_businesses(read_lines(spark, business_path))
    reviews = parse_reviews(read_lines(spark, review_path))
    out = {"ratings": f"{out_dir}/user_ratings", "top_rated": f"{out_dir}/top_rated"}
    q3 = ratings_for(businesses, reviews, pattern, per_business=per_business, match=match)
    write_lines(q3, out["ratings"], line=tab_line("userid", "stars", null_text=null_text), mode=mode)
    q4 = top_rated(reviews, businesses, k=k, by=by, dedup=dedup)
    write_lines(q4.coalesce(1), out["top_rated"],
                line=tab_line("businessid", "address", "categories", "avg_stars", null_text=null_text), mode=mode)
    return out


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m mutualis")
    sub = ap.add_subparsers(dest="job", required=True)
    both = argparse.ArgumentParser(add_help=False)
    both.add_argument("--out", required=True)
    both.add_argument("--k", type=int, default=DEFAULT_TOP_K)
    both.add_argument("--null-text", default="", help="text for a null field")
    both.add_argument("--scratch-dir", help="folder for intermediates that the driver and all executors share; "
                      "needed on a cluster that does not set spark.checkpoint.dir")
    f = sub.add_parser("friends", parents=[both], help="Q1 and Q2 from user profiles and adjacency lines")
    f.add_argument("--users", required=True)
    f.add_argument("--friends", required=True)
    f.add_argument("--how", choices=["inner", "left"], default="inner")
    f.add_argument("--strategy", choices=STRATEGIES, default="auto")
    f.add_argument("--hub-degree", type=int, default=DEFAULT_HUB_DEGREE)
    f.add_argument("--balance", type=float, default=DEFAULT_BALANCE)
    f.add_argument("--keep-zero", action="store_true", help="Q1: also pairs that share nobody")
    r = sub.add_parser("ratings", parents=[both], help="Q3 and Q4 from business and review records")
    r.add_argument("--business", required=True)
    r.add_argument("--reviews", required=True)
    r.add_argument("--pattern", default=DEFAULT_ADDRESS_PATTERN)
    r.add_argument("--match", choices=MATCH, default="contains")
    r.add_argument("--per-pair", action="store_true", help="Q3: one row per (user, stars)")
    r.add_argument("--dedup", action="store_true", help="Q4: mean over distinct review lines")
    r.add_argument("--by", choices=["mean", "key"], default="mean")
    args = ap.parse_args(argv)
    builder = SparkSession.builder.appName(f"mutualis-{args.job}")
    if args.scratch_dir:
        builder = builder.config("spark.checkpoint.dir", args.scratch_dir)
    spark = builder.getOrCreate()
    apply_tuning(spark)
    if args.job == "friends":
        out = friends_job(spark, args.users, args.friends, args.out, k=args.k, how=args.how, strategy=args.strategy,
                          hub_degree=args.hub_degree, balance=args.balance, keep_zero=args.keep_zero,
                          null_text=args.null_text)
    else:
        out = ratings_job(spark, args.business, args.reviews, args.out, pattern=args.pattern, k=args.k,
                          per_business=not args.per_pair, dedup=args.dedup, by=args.by, match=args.match,
                          null_text=args.null_text)
    for name, path in out.items():
        print(f"{name}: {path}")
