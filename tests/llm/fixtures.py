import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=False):
    """rows of (doc_id, text); with columns that clash with the operators' own if asked."""
    data = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    df = spark.createDataFrame(data, DOCS).repartition(3)
    if extra:
        from pyspark.sql import functions as F

        for name in ("ids", "score", "v", "node", "gone", "items", "th", "unit", "host", "n"):
            df = df.withColumn(name, F.lit("kept"))
    return df


def prose(seed, words):
    r = random.Random(seed)
    return " ".join(r.choice("the of and a in to river stone light under winter morning harbour copper quiet").strip() + (str(r.randrange(40)) if r.random() < 0.6 else "") for _ in range(words))
