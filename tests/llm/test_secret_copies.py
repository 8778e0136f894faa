"""Copies of one document with a secret leave the random-string model as it is."""

import random
import string

from pyspark.sql import functions as F

from pagesift.llm import secret_scan


def test_copies_of_a_secret_change_nothing(spark):
    rng = random.Random(3)

    def key():
        return "".join(rng.choices(string.ascii_letters + string.digits, k=28))

    def text():
        words = ("".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(4, 9))) for _ in range(20))
        return f"{' '.join(words)} token={key()}"

    rows = [(text(), 1) for _ in range(300)]
    copied = [(rows[0][0], 30_000), *rows[1:]]
    held = spark.createDataFrame([(key(),) for _ in range(200)], "w string")
    shares, models = [], []
    for table in (rows, copied):
        df = spark.createDataFrame(table, "text string, n int").select(F.explode(F.array_repeat("text", F.col("n"))).alias("text"))
        # a sample of every document, so that the ordinary strings are the same
        models.append(secret_scan.train(df, sample=40_000))
        hit = secret_scan.ratio(F.col("w"), models[-1].column()) >= secret_scan.THRESHOLD
        shares.append(held.agg(F.avg(hit.cast("int"))).first()[0])
    assert shares[0] == shares[1] > 0.8
    assert models[0] == models[1]
