"""Secret scan with a random forest that removes false positives.

DataFrame functions only: candidates are runs of token characters cut out by
one pattern; each gets statistics of its characters (length, classes and their
changes, transition probabilities of letters learnt from the corpus), its
coverage by the corpus dictionary, and what its path and neighbouring text
look like.  A random forest trained on labelled findings decides.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, stored, table

LEAST_CHARS = 14
# an "=" belongs to the run as padding only, not where it assigns what follows to it
RUN = r"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{%d,}+(?:={1,2}(?![A-Za-z0-9+/_\-=]|\s*[\"'`]))?" % LEAST_CHARS
CONTEXT = 40
SAMPLE = 10_000
LEAST_COUNT = 20
THRESHOLD = 0.5
KEYWORD = r"(?i)(token|passw|pwd|secret|api.?key|access.?key|credential|auth|private.?key)"
ASSIGNED = r"[=:]\s*[\"'`]?$"
FEATURES = [
    "len", "digits", "uppers", "lowers", "others", "changes", "variety", "transition", "covered",
    "keyword", "assigned", "quoted", "closed", "at_space", "in_url", "path_depth", "path_test", "path_code",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(id, text_hash, n, value, before, after, path): every run of token characters, numbered within its text.

    before and after are the ``CONTEXT`` characters of the text on either side,
    other candidates included.  Those have ``LEAST_CHARS`` characters at least,
    so the pieces around the nearest few hold the whole context.
    """
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    found = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_col).alias("text_hash"),
        path.alias("path"),
        F.col(text_col).alias("text"),
        F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0)).alias("values"),
    ).filter(F.size("values") > 0)
    near = range(1, -(-CONTEXT // LEAST_CHARS) + 1)
    before = [f"get({a}, n - {i})" for k in reversed(near) for a, i in (("values", k), ("parts", k - 1))]
    after = [f"get({a}, n + {k})" for k in near for a in ("parts", "values")]
    return (
        found.withColumn("parts", F.split("text", RUN, -1))
        .select("id", "text_hash", "path", "parts", "values", F.posexplode("values").alias("n", "value"))
        .select(
            "id",
            "text_hash",
            F.col("n").cast("long").alias("n"),
            "value",
            F.expr(f"right(concat_ws('', {', '.join(before)}), {CONTEXT})").alias("before"),
            F.expr(f"left(concat_ws('', {', '.join(after)}), {CONTEXT})").alias("after"),
            "path",
        )
    )


def dictionary(docs: DataFrame, text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, uses): lower-cased words of 3 to 16 letters that all texts together use ``least`` times or more."""
    words = docs.select(F.explode(F.split(F.lower(text_col), r"[^\p{L}]+")).alias("word"))
    return (
        words.filter(F.length("word").between(3, 16))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("uses"))
        .filter(F.col("uses") >= least)
    )


def _pairs(c: Column) -> Column:
    """The neighbouring pairs of characters of a string."""
    return F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substr(c, i, F.lit(2)))


def transitions(words: DataFrame) -> DataFrame:
    """(pair, logp): log probability of a pair's second letter after its first, over the dictionary's uses."""
    pairs = words.select(F.explode(_pairs(F.col("word"))).alias("pair"), "uses").groupBy("pair").agg(F.sum("uses").alias("c"))
    first = pairs.groupBy(F.substring("pair", 1, 1).alias("f")).agg(F.sum("c").alias("t"))
    return pairs.join(first, F.substring("pair", 1, 1) == F.col("f")).select(
        "pair", F.log((F.col("c") + 1) / (F.col("t") + 64)).alias("logp")
    )


def _share(c: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{kind}]", "")) / F.length(c)


def value_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """One row of character statistics for each distinct value."""
    v = F.col("value")
    values = stored(found.select("value").distinct().withColumn("vid", F.xxhash64("value")), "secret-values")
    low = F.lower(v)
    seen = (
        values.filter(F.length(v) > 1)
        .select("value", F.explode(_pairs(low)).alias("pair"))
        .join(transitions(words), "pair", "left")
        .groupBy("value")
        .agg(F.avg(F.coalesce("logp", F.lit(-9.0))).alias("transition"))
    )
    runs = values.select("value", F.explode(F.regexp_extract_all(low, F.lit(r"\p{L}{3,}"), F.lit(0))).alias("word"))
    covered = (
        runs.join(words.select("word", F.lit(1).alias("known")), "word", "left")
        .groupBy("value")
        .agg(F.sum(F.when(F.col("known") == 1, F.length("word")).otherwise(0)).alias("letters"))
    )
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[A-Z]", "U"), "[a-z]", "L"), "[0-9]", "0")
    return (
        values.join(seen, "value", "left")
        .join(covered, "value", "left")
        .select(
            "value",
            F.log1p(F.length(v)).alias("len"),
            _share(v, "0-9").alias("digits"),
            _share(v, "A-Z").alias("uppers"),
            _share(v, "a-z").alias("lowers"),
            _share(v, "+/=_\\\\-").alias("others"),
            (F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) / F.length(v)).alias("changes"),
            (F.size(F.array_distinct(F.split(low, ""))) / F.length(v)).alias("variety"),
            F.coalesce("transition", F.lit(-9.0)).alias("transition"),
            (F.coalesce("letters", F.lit(0)) / F.length(v)).alias("covered"),
        )
    )


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with all ``FEATURES`` as doubles."""
    before, after = F.coalesce("before", F.lit("")), F.coalesce("after", F.lit(""))
    path = F.lower(F.coalesce("path", F.lit("")))
    near = F.expr("right(coalesce(before, ''), 24)")
    out = found.join(value_features(found, words), "value").withColumns(
        {
            "keyword": near.rlike(KEYWORD) | F.col("value").rlike(KEYWORD),
            "assigned": before.rlike(ASSIGNED),
            "quoted": before.rlike(r"[\"'`]$"),
            "closed": after.rlike(r"^[\"'`]"),
            "at_space": before.rlike(r"(^|\s)$"),
            "in_url": near.rlike(r"(://|www\.|@)\S*$"),
            "path_depth": F.length(path) - F.length(F.regexp_replace(path, "/", "")),
            "path_test": path.rlike("test|example|sample|doc"),
            "path_code": path.rlike(r"\.(py|js|ts|java|go|rb|sh|env|ya?ml|json|cfg|ini|toml)$"),
        }
    )
    return out.withColumns({c: F.col(c).cast("double") for c in FEATURES})


def known_labels(found: DataFrame) -> DataFrame:
    """``found`` with y: 1 for findings in a format that is a secret's, 0 for harmless ones, null where unsure.

    Secrets: cloud access key ids, and values with a digit that a secret's name
    assigns.  Harmless: values of letters only or digits only without such a
    name, and values inside addresses.
    """
    near = F.expr("right(coalesce(before, ''), 24)")
    named = near.rlike(KEYWORD + r"\w*\s*[=:]\s*[\"'`]?$") & F.col("value").rlike("[0-9]")
    secret = F.col("value").rlike("^AKIA[0-9A-Z]{16}$") | named
    harmless = F.col("value").rlike(r"^([A-Za-z/_\-]+|[0-9\-]+)$") | near.rlike(r"(://|www\.|@)\S*$")
    return found.withColumn("y", F.when(secret, 1.0).when(harmless & ~near.rlike(KEYWORD), 0.0))


def scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
    trees: int = 30,
    depth: int = 6,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row for each candidate: doc_id, text_hash, n, value, score, is_secret.

    ``labelled`` holds labelled findings (doc_id, n, is_secret); without it the
    findings of ``known_labels`` are used.  The forest is fitted on at most
    about ``sample`` findings of each label, chosen by hash; dictionary and
    transitions count all texts.  Where one label is missing the score is 1 for
    findings labelled as secrets and 0 for the rest.  Null and empty texts have
    no candidates; a text that repeats gives its findings for each row; a null
    doc_id is carried.
    """
    found = stored(candidates(docs, id_col, text_col, path_col), "secret-found")
    words = stored(dictionary(docs, text_col), "secret-words")
    feats = stored(with_features(found, words), "secret-features")
    if labelled is not None:
        marks = labelled.select(
            F.col(id_col).cast("long").alias("_i"), F.col("n").cast("long").alias("_n"), F.col("is_secret").cast("double").alias("y")
        ).dropDuplicates(["_i", "_n"])
        feats = feats.join(marks, (F.col("id") == F.col("_i")) & (F.col("n") == F.col("_n")), "left").drop("_i", "_n")
    else:
        feats = known_labels(feats)
    known = feats.filter(F.col("y").isNotNull()).select("y", *FEATURES, F.xxhash64("id", "n", "value").alias("h"))
    train = stored(bounded_sample(known, "y", sample, F.col("h")), "secret-train")
    out = [F.col("id").alias("doc_id"), "text_hash", "n", "value"]
    if train.select("y").distinct().count() < 2:
        return feats.select(*out, F.coalesce("y", F.lit(0.0)).alias("score"), F.coalesce(F.col("y") == 1.0, F.lit(False)).alias("is_secret"))
    put = VectorAssembler(inputCols=FEATURES, outputCol="x")
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=17
    ).fit(put.transform(train).select("x", "y"))
    scored = forest.transform(put.transform(feats)).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*out, "score", (F.col("score") >= THRESHOLD).alias("is_secret"))


def redacted(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", mark: str = "[SECRET]", **how
) -> DataFrame:
    """``docs`` with every secret that ``scan`` confirms replaced by ``mark``; all rows and columns stay.

    Only texts with a candidate take part in the join; ``chars_col`` follows the new text.
    """
    hits = (
        scan(docs, id_col=id_col, text_col=text_col, **how)
        .filter("is_secret")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("n").alias("__llm_secret"))
        .select(F.col("doc_id").alias("__llm_d"), F.col("text_hash").alias("__llm_h"), "__llm_secret")
    )
    hits = stored(hits, "secret-hits")
    has = F.coalesce(F.col(text_col).rlike(RUN), F.lit(False))
    on = F.col(id_col).cast("long").eqNullSafe(F.col("__llm_d")) & (F.xxhash64(text_col) == F.col("__llm_h"))
    values, parts = F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0)), F.split(text_col, RUN, -1)
    shown = F.transform(
        F.col("__llm_values"), lambda v, i: F.when(F.array_contains("__llm_secret", i.cast("long")), F.lit(mark)).otherwise(v)
    )
    whole = F.concat_ws("", F.flatten(F.zip_with("__llm_parts", shown, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))))
    changed = (
        docs.filter(has)
        .join(hits, on, "left")
        .withColumn("__llm_values", F.when(F.col("__llm_secret").isNotNull(), values))
        .withColumn("__llm_parts", F.when(F.col("__llm_secret").isNotNull(), parts))
        .withColumn("__llm_new", F.when(F.col("__llm_secret").isNotNull(), whole))
    )
    fields = []
    for c in docs.columns:
        col = F.col(c)
        if c == text_col:
            col = F.coalesce("__llm_new", col).alias(c)
        elif c == chars_col:
            col = F.when(F.col("__llm_new").isNotNull(), F.length("__llm_new").cast(docs.schema[c].dataType)).otherwise(col).alias(c)
        fields.append(col)
    return docs.filter(~has).unionByName(changed.select(*fields))


def op5_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("length"), "score", "is_secret")
