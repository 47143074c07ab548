"""URL filter: allow/block rules, and gradient-boosted trees on lexical features for the rest.

Rules name a host and a path prefix; a rule fits its host and all subdomains, the longest rule
wins. URLs that a rule decides are the labelled ones: the trees are fitted on them (at most
``max_train`` different URLs, those of smallest hash, a documented bound) and judge the URLs that no
rule fits. Everything is DataFrame expressions and the JVM's own tree learner.

Features: lengths, path depth, digit ratio, character entropy, number of query parameters, labels,
hyphens and digits of the host, and suffix statistics: the smoothed share of blocked URLs among all
labelled URLs with the same last host label and the same last two.

Null, empty or scheme-less urls have an empty host and path and are judged by the method like any
other. With labels of one kind only (or none) the method's verdict is that kind (or allow).
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: (verdict, host, path prefix)
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
MAX_TRAIN = 20_000
TREES, DEPTH, STEP, SEED = 20, 4, 0.2, 7
SMOOTHING = 5.0
FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_digit_ratio", "f_entropy",
            "f_params", "f_labels", "f_hyphens", "f_host_digits", "f_https", "f_suffix1", "f_suffix2"]


def with_parts(df: DataFrame, url: str) -> DataFrame:
    """Adds ``_host``, ``_path`` and ``_query``."""
    u = f"coalesce(`{url}`, '')"
    rest = f"case when instr({u}, '://') > 0 then substring({u}, instr({u}, '://') + 3) else '' end"
    return df.withColumn("_rest", F.expr(rest)).withColumns({
        "_host": F.translate(F.regexp_extract("_rest", "^[^/?#]*", 0),
                             "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        "_path": F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1),
        "_query": F.regexp_extract("_rest", "^[^?#]*[?]([^#]*)", 1),
    }).drop("_rest")


def with_rule(df: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``_rule`` (host and path of the longest rule that fits, null if none does) and
    ``_ruled`` (its verdict)."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in reversed(ordered):
        fits = ((F.col("_host") == host) | F.col("_host").endswith("." + host)) & F.col("_path").startswith(path)
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return df.withColumns({"_rule": name, "_ruled": verdict})


def with_features(df: DataFrame, url: str) -> DataFrame:
    """Adds the lexical features and the host suffixes ``_s1`` and ``_s2``."""
    df = df.withColumn("_u", F.coalesce(F.col(url), F.lit("")))
    entropy = F.expr("""aggregate(array_distinct(split(_u, '')), 0D, (acc, c) -> acc + if(c = '', 0D,
        -((length(_u) - length(replace(_u, c, ''))) / length(_u))
        * log2((length(_u) - length(replace(_u, c, ''))) / length(_u))))""")

    def count(column: str, pattern: str) -> Column:
        return (F.length(column) - F.length(F.regexp_replace(column, pattern, ""))).cast("double")

    return df.withColumns({
        "f_length": F.length("_u").cast("double"),
        "f_host_length": F.length("_host").cast("double"),
        "f_path_length": F.length("_path").cast("double"),
        "f_depth": count("_path", "/"),
        "f_digit_ratio": F.when(F.length("_u") > 0, count("_u", "[0-9]") / F.length("_u")).otherwise(0.0),
        "f_entropy": F.when(F.length("_u") > 0, entropy).otherwise(0.0),
        "f_params": F.when(F.length("_query") > 0, count("_query", "&") + 1).otherwise(0.0),
        "f_labels": count("_host", "[.]") + 1,
        "f_hyphens": count("_host", "-"),
        "f_host_digits": count("_host", "[0-9]"),
        "f_https": F.col("_u").startswith("https:").cast("double"),
        "_s1": F.substring_index("_host", ".", -1),
        "_s2": F.substring_index("_host", ".", -2),
    }).drop("_u")


def _suffix_rates(train: DataFrame, suffix: str, name: str) -> DataFrame:
    """Smoothed share of blocked URLs per suffix."""
    return train.groupBy(suffix).agg(
        ((F.sum("label") + SMOOTHING / 2) / (F.count(F.lit(1)) + SMOOTHING)).alias(name))


def _with_rates(df: DataFrame, rates: list[tuple[str, str, DataFrame]]) -> DataFrame:
    for suffix, name, table in rates:  # as many rows as suffixes: the planner chooses the join
        df = df.join(table, suffix, "left").withColumn(name, F.coalesce(name, F.lit(0.5)))
    return df


def judge(pages: DataFrame, url: str = "url", rules=RULES, max_train: int = MAX_TRAIN,
          keep: list[str] | None = None) -> DataFrame:
    """The kept columns and ``host``, ``path``, ``rule`` (null: none fits), ``score`` (the trees'
    probability of block, null where a rule decides) and ``verdict`` (allow or block)."""
    added = ["host", "path", "rule", "score", "verdict"]
    carried = [c for c in (pages.columns if keep is None else keep) if c not in added]
    named = pages.select(F.struct(*[f"`{c}`" for c in carried]).alias("_kept"), F.col(url).alias("_url"))
    marked = with_rule(with_parts(named, "_url"), rules)
    labelled = marked.where("_ruled is not null and _url is not null").select(
        "_url", "_host", "_path", "_query", (F.col("_ruled") == "block").cast("double").alias("label")).distinct()
    labelled = materialize(labelled, "labelled")
    sample = labelled.orderBy(F.xxhash64("_url"), "_url").limit(max_train)
    sample, stats = materialize(sample, "labelled_urls", {"n": F.count(F.lit(1)), "blocked": F.sum("label")})
    n, blocked = stats["n"], stats["blocked"] or 0
    if blocked in (0, n):
        only = "block" if n and blocked else "allow"
        score, judged = F.lit(float(only == "block")), marked
    else:
        train, every = with_features(sample, "_url"), with_features(labelled, "_url")
        rates = [("_s1", "f_suffix1", materialize(_suffix_rates(every, "_s1", "f_suffix1"), "suffix1")),
                 ("_s2", "f_suffix2", materialize(_suffix_rates(every, "_s2", "f_suffix2"), "suffix2"))]
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        train = assembler.transform(_with_rates(train, rates)).select("features", "label")
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED).fit(materialize(train, "train_urls"))
        judged = model.transform(assembler.transform(_with_rates(with_features(marked, "_url"), rates)))
        score = F.element_at(vector_to_array("probability"), 2)
    decided = judged.withColumn("_score", F.when(F.col("_ruled").isNull(), score))
    return decided.select(
        "_kept.*", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
        F.col("_score").alias("score"),
        F.coalesce("_ruled", F.when(F.col("_score") > 0.5, "block").otherwise("allow")).alias("verdict"))

