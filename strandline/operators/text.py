"""Text: note statistics, sections, BM25 counts, cue-word concepts, class term weights, linkage to structured data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.sources.tables import checkpointed

TOKEN = r"[^\p{L}\p{N}]+"


def tokens(df: DataFrame, doc: str, text: str, keep: list[str] = ()) -> DataFrame:
    """doc, pos, token: lower-case runs of letters and digits, positions from 0 without gaps."""
    words = F.filter(F.split(F.lower(text), TOKEN), lambda t: t != "")
    return df.select(doc, *keep, F.posexplode(words).alias("pos", "token"))


def note_stats(df: DataFrame, kind: str, text: str, encounter: str, linked: DataFrame) -> DataFrame:
    """kind, n, length quantiles, notes an encounter, share linked to ``linked`` (whose first column is the encounter)."""
    known = linked.select(F.col(linked.columns[0]).alias(encounter)).distinct().withColumn("_k", F.lit(1))
    s = df.join(known, encounter, "left").groupBy(kind).agg(F.count("*").alias("n"), F.percentile(F.length(text), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), (F.count("*") / F.countDistinct(encounter)).alias("per_encounter"), F.avg(F.coalesce("_k", F.lit(0))).alias("linked"))
    return s.select(kind, "n", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "per_encounter", "linked")


def sections(df: DataFrame, doc: str, text: str, header: str) -> DataFrame:
    """doc, ordinal, name, char_start, char_end of the sections that the header regex (group 1: name) opens; offsets from 0, a section ends where the next begins."""
    cut = F.split(F.col(text), header)
    names = F.regexp_extract_all(F.col(text), F.lit(header), F.lit(1))
    heads = F.regexp_extract_all(F.col(text), F.lit(header), F.lit(0))
    d = df.select(doc, F.length(text).alias("_n"), F.posexplode(F.arrays_zip(names.alias("name"), heads.alias("head"), F.slice(cut, 1, F.size(names)).alias("before"))).alias("ordinal", "x"))
    w = Window.partitionBy(doc).orderBy("ordinal")
    start = F.sum(F.length("x.before")).over(w) + F.coalesce(F.sum(F.length("x.head")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    s = d.select(doc, "ordinal", F.lower("x.name").alias("name"), start.alias("char_start"), "_n")
    return s.withColumn("char_end", F.coalesce(F.lead("char_start").over(w), F.col("_n"))).drop("_n")


def search_counts(df: DataFrame, doc: str, text: str, kind: str, query: list[str], least: float, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """kind, hits, mean_score of documents whose BM25 score reaches ``least``."""
    t = tokens(df, doc, text, [kind])
    length = t.groupBy(doc, kind).agg(F.count("*").alias("dl"), *[F.count_if(F.col("token") == q).alias(f"tf{i}") for i, q in enumerate(query)])
    stats = length.agg(F.avg("dl").alias("avgdl"), F.count("*").alias("N"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(query))])
    j = length.crossJoin(F.broadcast(stats))  # one row of corpus statistics
    norm = k1 * (1 - b + b * F.col("dl") / F.col("avgdl"))
    part = lambda i: F.log(1 + (F.col("N") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5)) * F.col(f"tf{i}") * (k1 + 1) / (F.col(f"tf{i}") + norm)
    score = sum((part(i) for i in range(1, len(query))), part(0))
    return j.withColumn("s", score).where(F.col("s") >= least).groupBy(kind).agg(F.count("*").alias("hits"), F.avg("s").alias("mean_score"))


def extract_concepts(df: DataFrame, doc: str, text: str, targets: dict[str, str], triggers: dict[str, str], window: int = 6) -> DataFrame:
    """doc, pos, concept, assertion: target tokens, each with the assertion of the nearest trigger within the window of tokens (the earlier, then the first by name, on a tie), else affirmed.

    Targets and triggers are single tokens; hits are joined on the document and buckets of positions, so long texts don't pair all with all.
    """
    t = tokens(df, doc, text)
    name = lambda m: F.coalesce(*[F.when(F.col("token") == k, v) for k, v in m.items()])
    hits = t.withColumn("concept", name(targets)).where("concept is not null").select(doc, F.col("pos").alias("p"), "concept")
    cues = t.withColumn("assertion", name(triggers)).where("assertion is not null")
    width = 2 * window + 1
    a = hits.withColumn("_b", F.explode(F.array_distinct(F.array(F.floor((F.col("p") - window) / width), F.floor((F.col("p") + window) / width)))))
    c = cues.select(doc, F.col("pos").alias("_c"), "assertion", F.floor(F.col("pos") / width).alias("_b"))
    near = a.join(c, [doc, "_b"]).where(F.abs(F.col("p") - F.col("_c")) <= window)
    best = near.groupBy(doc, "p").agg(F.min(F.struct(F.abs(F.col("p") - F.col("_c")).alias("d"), F.col("_c"), F.col("assertion"))).alias("m"))
    return hits.join(best, [doc, "p"], "left").select(doc, F.col("p").alias("pos"), "concept", F.coalesce("m.assertion", F.lit("affirmed")).alias("assertion"))


def concept_flags(concepts: DataFrame, by: str) -> DataFrame:
    return concepts.groupBy(by).agg(F.count_if(F.col("assertion") == "affirmed").alias("n_affirmed"), F.count_if(F.col("assertion") == "negated").alias("n_negated"))


def class_terms(df: DataFrame, doc: str, text: str, label: str, k: int, least: int = 11) -> DataFrame:
    """label, term, n, weight, rank: the k terms with the largest class TF-IDF weight, among terms in at least ``least`` rows of tokens."""
    n = tokens(df, doc, text, [label]).groupBy(label, F.col("token").alias("term")).agg(F.count("*").alias("n"))
    total = n.groupBy("term").agg(F.sum("n").alias("_f")).where(F.col("_f") >= least)
    per = n.groupBy(label).agg(F.sum("n").alias("_w"))
    avg = per.agg(F.avg("_w").alias("_a"))
    j = n.join(total, "term").join(per, label).crossJoin(F.broadcast(avg))  # one row
    s = j.withColumn("weight", F.col("n") / F.col("_w") * F.log(1 + F.col("_a") / F.col("_f")))
    return s.withColumn("rank", F.row_number().over(Window.partitionBy(label).orderBy(F.desc("weight"), "term"))).where(F.col("rank") <= k).select(label, "term", "n", "weight", "rank")


def classify_text(train: DataFrame, test: DataFrame, text: str, label: str, features: int = 1 << 16) -> DataFrame:
    """``test`` with p: a logistic regression on TF-IDF of hashed words and pairs of words."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer, SQLTransformer
    from pyspark.ml.functions import vector_to_array

    stages = [RegexTokenizer(inputCol=text, outputCol="_w", pattern=r"\W+"), NGram(n=2, inputCol="_w", outputCol="_g"), SQLTransformer(statement="SELECT *, concat(_w, _g) AS _t FROM __THIS__"), HashingTF(inputCol="_t", outputCol="_h", numFeatures=features), IDF(inputCol="_h", outputCol="_x", minDocFreq=2), LogisticRegression(featuresCol="_x", labelCol="_y", maxIter=20, regParam=0.01, probabilityCol="_p", rawPredictionCol="_r", predictionCol="_d")]
    m = Pipeline(stages=stages).fit(train.withColumn("_y", F.col(label).cast("double")))
    return m.transform(test.withColumn("_y", F.col(label).cast("double"))).select(*test.columns, vector_to_array("_p")[1].alias("p"))


def topic_clusters(df: DataFrame, doc: str, text: str, k: int, features: int = 1 << 14, seed: int = 1) -> DataFrame:
    """doc, topic: k-means on TF-IDF of hashed words, scaled to unit length; ``class_terms`` names a topic's words. Texts are split once; all later passes read their counts."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer

    d = df.select(doc, F.coalesce(text, F.lit("")).alias("_text"))
    words = RegexTokenizer(inputCol="_text", outputCol="_w", pattern=r"\W+").transform(d)
    h = checkpointed(HashingTF(inputCol="_w", outputCol="_h", numFeatures=features).transform(words).select(doc, "_h"))
    stages = [IDF(inputCol="_h", outputCol="_x", minDocFreq=2), Normalizer(inputCol="_x", outputCol="_u"), KMeans(k=k, seed=seed, featuresCol="_u", predictionCol="topic", maxIter=10)]
    return Pipeline(stages=stages).fit(h).transform(h).select(doc, "topic")
