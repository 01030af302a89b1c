"""Packing and archives on Spark against their laws: NULLs, empty and long texts, repeats, empty tables, extra columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waybill.llm import packing, warc

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, length long, part string, ids string"
PAGES = "page_id long, url string, html string, payload string, _id long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 7, "x", "y") for i, t in rows], DOCS)


def test_packing_laws(spark):
    pick = random.Random(3)
    words = ["the", "cat", " ", "münchen", "12", "\n", "of", "stream", "日本"]
    rows = [(0, None), (1, ""), (2, "a b " * 4000), (3, "x")]
    rows += [(k, " ".join(pick.choice(words) for _ in range(pick.randint(1, 700)))) for k in range(4, 90)]
    rows += [rows[2], rows[10], (None, "without an id")]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    found = packing.packed(docs(spark, rows).repartition(5), VOCABULARY).collect()

    covered, sequences = defaultdict(Counter), defaultdict(list)
    for r in found:
        own = ids[r["doc_id"]]
        piece = own[r["start"] : r["start"] + r["length"]]
        assert len(piece) == r["length"] > 0 and r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes())
        covered[r["doc_id"]].update(range(r["start"], r["start"] + r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    times = Counter(i for i, _ in rows)
    assert covered == {i: Counter(dict.fromkeys(range(len(own)), times[i])) for i, own in ids.items()}
    open_ones = []
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        if end != packing.CAPACITY:
            open_ones.append(end)
    assert all(end < packing.CAPACITY and end & (end - 1) == 0 for end in open_ones) and len(open_ones) <= 10


def test_packing_of_no_documents(spark):
    assert packing.packed(docs(spark, []), VOCABULARY).collect() == []


def archived(spark, rows, path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", h, "x", 5) for i, h in rows], PAGES)
    warc.write_warc(warc.page_records(pages.repartition(3)), path)
    return warc.read_warc(spark, path)


def test_archive_round_trip(spark, tmp_path):
    big, odd = "ab\r\n\r\nWARC/1.0\r\n" * 90, "é日" * 400
    rows = [(1, big), (2, big), (5, big), (3, None), (4, ""), (6, "short"), (7, "short"), (8, odd), (9, odd), (10, "z" * 999), (11, "z" * 999)]
    path = str(tmp_path / "archive")
    found = archived(spark, rows, path).where(F.col("record_type").isin("response", "revisit")).collect()
    last = {}
    for i, h in rows:
        last[h] = max(i, last.get(h, i))
    got = {}
    for r in found:
        assert r["record_id"] not in got
        got[r["record_id"]] = (r["record_type"], r["refers_to"], r["payload_digest"])
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() == (dict(rows)[int(r["record_id"])] or "")
    expected = {}
    for i, h in rows:
        data = (h or "").encode()
        again = len(data) >= 1000 and last[h] > i
        expected[str(i)] = ("revisit" if again else "response", str(last[h]) if again else None, hashlib.sha1(data).hexdigest())
    assert got == expected


def test_archive_of_no_pages(spark, tmp_path):
    assert archived(spark, [], str(tmp_path / "none")).where("record_type = 'response'").collect() == []
