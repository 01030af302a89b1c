"""The whole pipeline on hand-made rows: what each stage takes, and that clean documents stay whole."""

import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


def sentence(seed, n):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghilmnoprstu") for _ in range(pick.randint(3, 8))) for _ in range(n))


def test_pipeline_on_planted_rows(spark, tmp_path):
    item, passage = sentence(900, 30), sentence(901, 60)
    copied = sentence(1, 80)
    near = copied.rsplit(" ", 2)[0] + " other end"
    texts = {
        1: copied,
        2: near,
        3: copied,
        4: sentence(4, 50) + " " + passage,
        5: passage + " " + sentence(5, 50),
        6: sentence(6, 90) + " " + item + " " + sentence(7, 40),
        7: "12345 --- 678",
        8: None,
        9: "",
    }
    texts |= {k: sentence(k, 70) for k in range(20, 60)}
    rows = [(k, t, "aa" if k % 2 else "bb", "web", len(t or "")) for k, t in texts.items()]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} == {1, 4, 5, *range(20, 60)}
    length = {}
    for r in found:
        length[r["doc_id"]] = length.get(r["doc_id"], 0) + r["length"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    count = {k: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for k, t in texts.items()}
    assert all(length[k] == count[k] for k in length if k != 5)
    cut = len(tokenizer.encode(" " + sentence(5, 50), add_special_tokens=False).ids) + 1
    assert abs(length[5] - cut) <= 2 < count[5] - length[5]
