"""URL filter: longest host and path rules first, then logistic regression on hashed character n-grams
of host and path. DataFrame and ML-pipeline operations only; nothing is shuffled.

The model learns from a table of labelled urls, which is an input. Where none is given, ``labelled_urls`` makes one from word
lists by a rule: invented hosts under reserved top-level names, of which no judged page can come. ``held_out_accuracy`` fits on
three quarters of such a table and judges the rest.

A null url, or one without ``://``, has an empty host and path; such a url has no n-grams and gets the
model's intercept. Long urls are read whole. Repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (host, path, verdict). A rule fits its host and every subdomain where the url's path starts with its path.
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]

# Words of hosts and paths that a labelled url of each kind is made of, and words that both kinds have.
WORDS = {
    0: ("weather garden library museum science history travel recipe journal school research health music kitchen archive bakery forest village river nature".split(),
        "article guide chapter lesson report story exhibit manual essay review paper course map timetable".split()),
    1: ("casino pills cheap spam slots poker viagra jackpot loans replica adult cams bonus winprize clickfarm followers crack keygen payday betting".split(),
        "buy win free-money order-now jackpot click join-now deal bonus claim hot offer cash unlock".split()),
}
SYLLABLES = "ba be bri cor da del er fa fen gal han hol in ja ka lan li ma mer na nor on pa per qui ra ren sa ser ta ter un va wen yo zan the than tion".split()
PLAIN_HOST, PLAIN_PATH, TOPS = "www blog news m shop docs online my the city".split(), "en de fr es item page id posts 2021 index".split(), "test invalid example localhost".split()

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; both null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _grams(text: str, tag: str) -> str:
    """SQL for the tagged n-grams of a column, none for an empty one."""
    padded = f"concat('^', {text}, '$')"
    parts = [f"if(length({text}) > 0 and length({padded}) >= {n}, transform(sequence(1, length({padded}) - {n - 1}), i -> concat('{tag}', substring({padded}, i, {n}))), cast(array() as array<string>))" for n in GRAMS]
    return f"concat({', '.join(parts)})"


def with_features(urls: DataFrame) -> DataFrame:
    """Adds __host, __path and __features."""
    df = urls.withColumns({"__host": host_of(F.col("__url")), "__path": path_of(F.col("__url"))})
    df = df.withColumn("__grams", F.expr(f"concat({_grams('__host', 'h')}, {_grams('__path', 'p')})"))
    return HashingTF(inputCol="__grams", outputCol="__features", numFeatures=BUCKETS, binary=True).transform(df).drop("__grams")


def labelled_urls(spark: SparkSession, rows: int = 1200) -> DataFrame:
    """url, label (1: block): as many of either kind. One word of the kind is in the host, a second in host or path or nowhere;
    what else the parts are made of, both kinds share. Half of the hosts to allow are made of syllables instead, so that names which
    nothing is known of are allowed. The same rows every time."""
    pick = lambda words, k: F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(words))) + 1).cast("int"))
    kind = lambda j, k: F.when(F.col("label") == 1, pick(WORDS[1][j], k)).otherwise(pick(WORDS[0][j], k))
    way, number = F.pmod(F.xxhash64("id", F.lit("way")), F.lit(3)), F.pmod(F.xxhash64("id", F.lit("n")), F.lit(1000)).cast("string")
    host = F.concat(pick(PLAIN_HOST, "a"), F.lit("."), kind(0, "h"), F.when(way == 1, F.concat(F.lit("-"), kind(0, "i"))).otherwise(F.lit("")), F.lit("."), pick(TOPS, "t"))
    path = F.concat(F.lit("/"), pick(PLAIN_PATH, "p"), F.lit("/"), F.when(way == 2, F.concat(kind(1, "q"), F.lit("/"))).otherwise(F.lit("")), number)
    made = F.concat(*(pick(SYLLABLES, f"s{k}") for k in range(3)))
    host = F.when((F.col("label") == 0) & (F.col("id") % 4 == 0), F.concat(pick(PLAIN_HOST, "a"), F.lit("."), made, F.lit("."), pick(TOPS, "t"))).otherwise(host)
    table = spark.range(0, rows, 1, 1).withColumn("label", (F.col("id") % 2).cast("int"))
    return table.select(F.concat(F.lit("https://"), host, path).alias("url"), "label")


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label") -> LogisticRegressionModel:
    """Fit on a small table of urls and labels (1 to block, 0 to allow; other and null labels are left out). The rows are put in
    one order in one partition, so that reruns agree."""
    table = labelled.select(F.col(url_col).alias("__url"), F.col(label_col).cast("double").alias("label")).where("label in (0, 1)")
    table = with_features(table.coalesce(1).sortWithinPartitions("__url", "label"))
    return LogisticRegression(featuresCol="__features", labelCol="label", regParam=0.01, maxIter=50, predictionCol="__pred", probabilityCol="__prob", rawPredictionCol="__raw").fit(table)


def held_out_accuracy(labelled: DataFrame, url_col: str = "url", label_col: str = "label") -> float:
    """The share of urls judged as labelled, of the quarter that the model isn't fitted to."""
    part = F.pmod(F.xxhash64(url_col), F.lit(4))
    model = train(labelled.where(part > 0), url_col, label_col)
    other = with_features(labelled.where(part == 0).select(F.col(url_col).alias("__url"), F.col(label_col).alias("__label")))
    return model.transform(other).agg(F.avg((F.col("__pred") == F.col("__label")).cast("double"))).first()[0]


def judge_urls(pages: DataFrame, url_col: str = "url", rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """The input's rows with host, path, rule, and verdict: the rule's, else that of the model that learns from ``labelled``
    (url, label)."""
    model = train(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    df = pages.drop("host", "path", "rule", "verdict").withColumn("__url", F.col(url_col))
    df = model.transform(with_features(df))
    rule, verdict = rule_of(F.col("__host"), F.col("__path"), rules)
    out = df.withColumns({"host": F.col("__host"), "path": F.col("__path"), "rule": rule, "verdict": F.coalesce(verdict, F.when(F.col("__pred") == 1.0, "block").otherwise("allow"))})
    return out.drop("__url", "__host", "__path", "__features", "__raw", "__prob", "__pred")
