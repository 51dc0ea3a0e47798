"""URL verdicts: rules on hosts and paths, and boosted trees on lexical features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstar.llm.common import body

# Rule: (verdict, host, path prefix).
Rule = tuple[str, str, str]
RULES: list[Rule] = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

TRAIN_ROWS = 10_000  # most labelled URLs that the trees are fitted on, lowest hashes first
SMOOTHING = 20.0  # labelled URLs at which a suffix's own share counts half
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: str) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    found = F.regexp_extract(body(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: str) -> Column:
    return F.regexp_extract(body(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _rule_name(rule: Rule) -> str:
    return rule[1] + rule[2]


def rule_columns(host: str, path: str, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule's name and verdict; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(_rule_name(r)), _rule_name(r))):
        fits = (F.col(host) == rule[1]) | F.col(host).endswith(f".{rule[1]}")
        fits = fits & F.col(path).startswith(rule[2])
        name = F.when(fits, F.lit(_rule_name(rule))).otherwise(name)
        verdict = F.when(fits, F.lit(rule[0])).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Shannon entropy of all characters, in bits, from the runs of the sorted ones."""
    chars = F.sort_array(F.filter(F.split(text, ""), lambda c: c != ""))
    n = F.greatest(F.size(chars), F.lit(1))

    def term(run: Column) -> Column:
        return F.when(run == 0, 0.0).otherwise(-(run / n) * F.log2(run / n))

    def step(done: Column, c: Column) -> Column:
        same = c == done["char"]
        return F.struct(
            c.alias("char"),
            F.when(same, done["run"] + 1).otherwise(F.lit(1)).alias("run"),
            F.when(same, done["total"]).otherwise(done["total"] + term(done["run"])).alias("total"),
        )

    start = F.struct(F.lit("").alias("char"), F.lit(0).alias("run"), F.lit(0.0).alias("total"))
    return F.aggregate(chars, start, step, lambda done: done["total"] + term(done["run"]))


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the features of ``url`` (not null), ``host`` and ``path``."""
    url, length = F.col("url"), F.char_length("url")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    last = F.substring_index("path", "/", -1)
    features = {
        "f_length": length,
        "f_host_length": F.char_length("host"),
        "f_path_length": F.char_length("path"),
        "f_host_depth": F.size(F.split("host", r"\.")),
        "f_path_depth": F.char_length("path") - F.char_length(F.replace("path", F.lit("/"))),
        "f_digits": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(length, F.lit(1)),
        "f_hyphens": F.regexp_count(F.col("host"), F.lit("-")),
        "f_entropy": _entropy(F.col("host")),
        "f_path_entropy": _entropy(F.col("path")),
        "f_params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "f_fragment": url.contains("#").cast("int"),
        "f_secure": F.lower(url).startswith("https:").cast("int"),
        "f_last_digits": F.regexp_count(last, F.lit("[0-9]")),
        "f_extension": last.contains(".").cast("int"),
    }
    return urls.withColumns({k: v.cast("double") for k, v in features.items()})


FEATURES = [
    "f_length", "f_host_length", "f_path_length", "f_host_depth", "f_path_depth", "f_digits",
    "f_hyphens", "f_entropy", "f_path_entropy", "f_params", "f_fragment", "f_secure",
    "f_last_digits", "f_extension", "f_suffix_share", "f_suffix_urls", "f_folder_share",
]


def _shares(labelled: DataFrame, key: str, name: str) -> DataFrame:
    """Per key, over all rows: URLs, and the smoothed share of labelled ones to block."""
    counts = labelled.groupBy(F.col(key).alias(f"__{key}")).agg(
        F.count(F.lit(1)).alias("urls"),
        F.count("label").alias("known"),
        F.sum("label").alias("blocked"),
    )
    share = (F.coalesce("blocked", F.lit(0)) + 0.5 * SMOOTHING) / (F.col("known") + SMOOTHING)
    return counts.select(
        f"__{key}", share.alias(f"f_{name}_share"), F.log("urls").alias(f"f_{name}_urls")
    )


def features(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path, label or null) with all features.

    Statistics of suffixes (last host label) and of first path folders come from all rows,
    as counts per key before the join; Spark splits the rows of a hot key there.
    """
    keyed = lexical(urls).withColumn("suffix", F.substring_index("host", ".", -1)).withColumn(
        "folder", F.split_part("path", F.lit("/"), F.lit(2))
    )
    suffixes, folders = _shares(keyed, "suffix", "suffix"), _shares(keyed, "folder", "folder")
    return keyed.join(suffixes, F.col("suffix") == F.col("__suffix")).join(
        folders.drop("f_folder_urls"), F.col("folder") == F.col("__folder")
    ).drop("__suffix", "__folder")


def fit(rows: DataFrame, seed: int = 0, trees: int = 20, depth: int = 4) -> GBTClassificationModel | None:
    """Trees fitted on at most TRAIN_ROWS distinct labelled URLs; None if a verdict is missing."""
    sample = (
        rows.where("label is not null and host <> ''")
        .select("url", "label", *FEATURES)
        .withColumn("draw", F.xxhash64("url", F.lit(seed)))
        .dropDuplicates(["url"])
        .orderBy("draw", "url")
        .limit(TRAIN_ROWS)
    )
    # The rows in a fixed order in a few partitions, so that every run bins them alike.
    sample = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    sample = sample.select("draw", "label", "features").coalesce(1).sortWithinPartitions("draw").cache()
    try:
        if sample.select("label").distinct().count() < 2:
            return None
        return GBTClassifier(
            maxIter=trees, maxDepth=depth, seed=seed, stepSize=0.2, maxBins=64
        ).fit(sample.select("label", "features"))
    finally:
        sample.unpersist()


def url_verdicts(
    pages: DataFrame, id: str = "page_id", url: str = "url", rules: Sequence[Rule] = RULES,
    seed: int = 0, cut: float = 0.5,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, block_probability.

    The longest fitting rule decides; else the trees, trained on the URLs that rules decide,
    block from a probability of ``cut`` on. A URL that is null or has no ``://`` has an empty
    host and path, fits no rule and is blocked. Without labelled URLs of both verdicts there
    are no trees, and what no rule decides is allowed. Repeated rows get one row each; only
    the id and url are read.
    """
    rows = pages.select(F.col(id).alias("page_id"), body(url).alias("url"))
    rows = rows.withColumns({"host": host("url"), "path": path("url")})
    rule, verdict = rule_columns("host", "path", rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    rows = features(rows.withColumn("label", (F.col("ruled") == "block").cast("double")))
    model = fit(rows, seed)
    if model is None:
        judged = rows.withColumn("block_probability", F.lit(0.0))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
        judged = model.transform(vectors).withColumn(
            "block_probability", vector_to_array("probability").getItem(1)
        )
    blocked = (F.col("host") == "") | (F.col("block_probability") >= cut)
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        "block_probability",
    )
