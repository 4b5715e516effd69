"""Quality classifier with hierarchical empirical Bayes.

A logistic regression over telling words and style figures gives each document's evidence. The
evidence of all documents is grouped by host and by path; a host's posterior is its mean shrunk
towards the global one, a path's is shrunk towards its host's, the more the fewer documents there
are. The shrinkage comes from the spread of the group means (method of moments). A document's
score is its own log odds, moved by the log odds of its path without the document itself.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_rows, let, stored, table, words

# The classifier learns from about this many labelled documents, drawn by a hash of their ids.
MAX_TRAINING_DOCS = 20_000
# Words that rejected documents hold more often than chance allows, the most telling first.
MAX_WORDS = 2_000
MIN_Z = 5.0
TRAINING_TASKS = 6
LEAST = 1e-4


def style(text: Column, w: Column) -> list[Column]:
    """Figures of one text that do not grow with its length."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    size = F.greatest(F.size(w), F.lit(1))

    def share(letters: str) -> Column:
        return F.regexp_count(t, F.lit(f"[{letters}]")) / n

    return [
        share("A-Z"),
        share("0-9"),
        share("#*$%&"),
        share(r"|<>{}\[\]"),
        share("!?"),
        share(".,;:"),
        share("\n"),
        F.size(F.array_distinct(w)) / size,
        n / size / 10,
        (F.size(w) < 10).cast("double"),
        F.log(size.cast("double")) / 10,
    ]


def features(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``words`` (letters and digits in lower case, each once) and ``style``."""
    t = F.col(text)
    plain = F.array_distinct(words(F.lower(F.regexp_replace(F.coalesce(t, F.lit("")), r"[\p{Punct}]+", ""))))
    shown = let(
        words(t),
        lambda w: F.struct(plain.alias("words"), F.array(*[c.cast("double") for c in style(t, w)]).alias("style")),
    )
    return docs.withColumn("_f", shown).select("*", "_f.words", "_f.style").drop("_f")


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS, doc_id: str = "doc_id", text: str = "text"):
    """A pipeline model of P(reject): labelled quality 0 or toxic 1. ``None`` if the labels hold
    fewer than two classes: every document then has the same evidence. Rows with null ids or labels
    are not used."""
    marked = labels.where("doc_id is not null and (quality is not null or toxic is not null)").select(
        F.col("doc_id").alias("label_id"),
        F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("quality") == 0, 1.0).otherwise(0.0).alias("low"),
        F.when(F.col("toxic") == 1, 1.0).otherwise(0.0).alias("toxic"),
    )
    n = marked.count()
    share = min(1.0, max_docs / max(n, 1))
    drawn = marked.where(F.pmod(F.xxhash64("label_id", F.lit(17)), F.lit(1_000_000)) < share * 1_000_000)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # about max_docs rows by the draw above, so no text is shuffled for them
    rows = features(source.join(F.broadcast(drawn), F.col("doc_id") == F.col("label_id")), "text")
    dense = rows.select("label", "low", "toxic", "words", *[F.get("style", k).alias(f"s{k}") for k in range(11)])
    # dealt anew: a coalesce would run the join over all documents in so few tasks
    sample = stored(dense.repartition(TRAINING_TASKS), "training")
    if sample.select("label").distinct().count() < 2:
        return None
    vocabulary = telling_words(sample)
    assembled = VectorAssembler(inputCols=[f"s{k}" for k in range(11)] + (["held"] if vocabulary else []), outputCol="features")
    stages = [assembled, LogisticRegression(maxIter=60, regParam=1e-3, tol=1e-5)]
    if vocabulary:
        stages.insert(0, CountVectorizerModel.from_vocabulary(vocabulary, inputCol="words", outputCol="held", minTF=0.0))
        stages[0].setBinary(True)
    return Pipeline(stages=stages).fit(sample.coalesce(TRAINING_TASKS))


def telling_words(sample: DataFrame) -> list[str]:
    """The words whose documents are of low quality, or toxic, more often than all are, by at least
    ``MIN_Z`` standard deviations; at most ``MAX_WORDS``, ties by the word."""
    kinds = ["low", "toxic"]
    rates = sample.agg(*[F.avg(k).alias(k) for k in kinds]).first()
    words = sample.select(*kinds, F.explode("words").alias("word")).where("word <> ''")
    seen = words.groupBy("word").agg(F.count("*").alias("n"), *[F.sum(k).alias(k) for k in kinds])

    def z(kind: str) -> Column:
        p = rates[kind]
        if not 0 < p < 1:
            return F.lit(0.0)
        return F.when(F.col(kind) >= 4, (F.col(kind) - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p))).otherwise(0.0)

    strongest = F.greatest(*[z(k) for k in kinds])
    top = seen.select("word", strongest.alias("z")).where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "word").limit(MAX_WORDS)
    return [r["word"] for r in top.collect()]


def evidence(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with ``good``, the classifier's probability that the document is fit to keep."""
    if model is None:
        return docs.withColumn("good", F.lit(0.5))
    rows = features(docs, text).select("*", *[F.get("style", k).alias(f"s{k}") for k in range(11)])
    good = F.get(vector_to_array("probability"), 0)
    return model.transform(rows).select(*[F.col(f"`{c}`") for c in docs.columns], F.greatest(F.lit(LEAST), F.least(F.lit(1 - LEAST), good)).alias("good"))


def _strength(groups: DataFrame, n: str, mean: str, around: str) -> float:
    """Size of the prior, in documents: from the spread of the group means beyond what their own
    documents explain."""
    p = F.col(around)
    row = groups.select(
        F.sum(F.col(n) * (F.col(mean) - p) ** 2).alias("spread"),
        F.sum(p * (1 - p)).alias("noise"),
        F.sum(F.col(n) * p * (1 - p)).alias("scale"),
    ).first()
    if not row["scale"]:
        return 1.0
    between = (row["spread"] - row["noise"]) / row["scale"]
    return float(min(1e4, max(1.0, 1 / between if between > 0 else 1e4)))


def posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """``host, path, n, total, host_posterior, prior_strength`` of every path, and the global mean.
    ``scored`` holds ``host, path, good``."""
    paths = stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("good").alias("total")), "paths")
    whole = paths.agg(F.sum("n").alias("n"), F.sum("total").alias("t")).first()
    mean = whole["t"] / whole["n"] if whole["n"] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("total").alias("host_total"))
    hosts = hosts.withColumn("host_mean", F.col("host_total") / F.col("host_n")).withColumn("global", F.lit(mean))
    s = _strength(hosts, "host_n", "host_mean", "global")
    shrunk = hosts.select(
        F.col("host").alias("h"), ((F.col("host_total") + s * mean) / (F.col("host_n") + s)).alias("host_posterior")
    )
    joined = stored(
        paths.join(shrunk, paths["host"].eqNullSafe(F.col("h"))).drop("h").withColumn("path_mean", F.col("total") / F.col("n")), "posteriors"
    )
    return joined.withColumn("strength", F.lit(_strength(joined, "n", "path_mean", "host_posterior"))), mean


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def site_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    max_training_docs: int = MAX_TRAINING_DOCS,
) -> DataFrame:
    """One row per input row: ``doc_id, text_hash, host, path, doc_score, host_posterior,
    path_posterior, score, kept``. A document is kept if its score, a probability, is at least a
    half. Null hosts and paths are groups of their own; null texts are empty texts; an empty table
    gives no rows; without usable labels every document has the evidence 0.5 and is kept."""
    model = train(docs, labels, max_training_docs, doc_id, text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
        F.col(host).cast("string").alias("host"),
        F.col(path).cast("string").alias("path"),
    )
    scored = stored(evidence(rows, model).drop("text"), "scored")
    groups, mean = posteriors(scored)
    g = groups.select(F.col("host").alias("h"), F.col("path").alias("p"), "n", "total", "host_posterior", "strength")
    joined = scored.join(g, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    others = (F.col("total") - F.col("good") + F.col("strength") * F.col("host_posterior")) / (F.col("n") - 1 + F.col("strength"))
    bounded = F.greatest(F.lit(LEAST), F.least(F.lit(1 - LEAST), others))
    whole = F.lit(min(1 - LEAST, max(LEAST, mean)))
    log_odds = _logit(F.col("good")) + _logit(F.col("path_posterior")) - _logit(whole)
    return (
        joined.withColumn("path_posterior", bounded)
        .withColumn("score", 1 / (1 + F.exp(-log_odds)))
        .select(
            "doc_id", "text_hash", "host", "path", F.col("good").alias("doc_score"), "host_posterior", "path_posterior", "score",
            (F.round("score", 9) >= 0.5).alias("kept"),
        )
    )


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are kept, with all their columns; rows that agree in id and text go
    together when any of them is rejected."""
    verdicts = site_quality(docs, labels, doc_id, text, **options)
    bad = verdicts.where("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    return drop_rows(docs, stored(bad.distinct(), "rejected"), doc_id, text)


def op8_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its evidence, the posteriors of its site, and the verdict."""
    return site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")
