"""Toxic spans on Spark: held-out rows, spans of planted words, NULLs, repeats, extra columns and no labels."""

import random
import zlib

from waybill.llm import toxicity

DOCS = "doc_id long, text string, label long, n long, toxic string"


def planted(n):
    pick = random.Random(11)
    plain = ["river", "stone", "market", "window", "garden", "letter", "music", "winter", "paper", "bridge"]
    foul = ["grubface", "slimeball", "wretchling"]
    rows, toxic = [], {}
    for k in range(n):
        words = [pick.choice(plain) for _ in range(pick.randint(15, 40))]
        toxic[k] = int(k % 4 == 0)
        if toxic[k]:
            for _ in range(3):
                words.insert(pick.randrange(len(words)), pick.choice(foul))
        rows.append((k, " ".join(words)))
    return rows, toxic


def frames(spark, rows, labels):
    documents = spark.createDataFrame([(i, t, 5, 6, "x") for i, t in rows], DOCS)
    return documents, spark.createDataFrame([(k, 1, v) for k, v in labels.items()], "doc_id long, quality int, toxic int")


def test_held_out_documents_and_odd_rows(spark):
    rows, toxic = planted(400)
    odd = [(1000, None), (1001, ""), (1002, "12 -- 3"), (None, rows[0][1]), rows[3], (1003, "river stone " * 5000)]
    documents, labels = frames(spark, rows + odd, toxic)
    found = toxicity.tag(documents.repartition(4), toxicity.fit(documents, labels)).collect()
    assert len(found) == len(rows) + len(odd)
    held = [r for r in found if r["doc_id"] in toxic and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert all(r["held_out"] for r in held) and len(held) > 80
    assert sum(r["predicted"] == toxic[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[k]["predicted"] == 0 for k in (1000, 1001, 1002, 1003))
    assert by_id[None]["score"] == by_id[0]["score"]


def test_without_labels_or_documents(spark):
    rows, _ = planted(6)
    documents, _ = frames(spark, rows, {1: 0})
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.tag(documents, toxicity.fit(documents, none)).collect()
    assert len(found) == 6 and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.tag(documents.limit(0), toxicity.fit(documents, none)).collect() == []
