"""Toxicity (operator 2): a group of copies must not take the sample and the features."""

import numpy as np
from pyspark.sql import functions as F

from provisio.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_copies_of_one_toxic_text_change_nothing(spark):
    """A third of the toxic rows are copies of one text: the same features, and held-out texts are found as without them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    mine = labels.where("toxic = 1").where(toxicity.fold() != 0)
    one = mine.join(docs, "doc_id").where("length(text) between 3000 and 5000").orderBy("doc_id").first()
    copies = spark.range(10 ** 9, 10 ** 9 + 2000).withColumnRenamed("id", "doc_id").where(toxicity.fold() != 0).limit(mine.count() // 2)
    more = docs.unionAll(copies.select("doc_id", F.lit(one["text"]).alias("text")))
    model = toxicity.train(more, labels.unionAll(copies.select("doc_id", F.lit(1).alias("toxic"))))
    assert (model[0] == toxicity.train(docs, labels)[0]).all() and len(model[0]) > 1024
    got = toxicity.score(docs, model).where("held_out").join(labels, "doc_id").select("toxic", "score").toPandas()
    pos, neg = (got.score[got.toxic == c].to_numpy() for c in (1, 0))
    assert (pos[:, None] > neg[None]).mean() >= 0.95 and (pos >= 0.5).mean() >= 0.85 and (neg >= 0.5).mean() <= 0.01


def test_fit_reaches_the_optimum():
    """The loss's gradient vanishes, also with many more features than documents."""
    r = np.random.default_rng(4)
    x, y = r.normal(size=(60, 300)), (r.random(60) < 0.4).astype(float)

    def slope(w, bias):
        margin = x @ w + bias
        off = (1 / (1 + np.exp(-margin)) - y) / 60
        return float(np.logaddexp(0, np.where(y > 0, -margin, margin)).mean()), x.T @ off, off.sum()

    w, bias = toxicity.fit(slope, 300, 0.0, steps=300)
    _, g, gb = slope(w, bias)
    assert np.abs(g + toxicity.L2 * w).max() < 1e-3 and abs(gb) < 1e-3
