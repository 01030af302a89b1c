"""The operators on Spark against brute force: NULLs, ties, repeats, empty tables, extra columns."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waybill.llm import ann, bpe, chat, components, decontam, importance, langid, ngram_join, phrases, shared, sharding, substrings

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, ids string, n long, part string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    """Documents with extra columns that clash with names used inside."""
    return spark.createDataFrame([(i, t, lang, "x", 7, "y") for i, t, lang in rows], DOCS)


# --- byte-pair encoding ------------------------------------------------------


def test_bpe_equals_the_library(spark):
    rng = random.Random(1)
    signs = [*" \n\t'abcdehllmorstvxé日 ́٣½.,!?-_", "<|endoftext|>", "<|endof", "'ll", "  ", "\x00", "😀"]
    texts = [None, "", "a" * 3000, " " * 999, "x<|endoftext|>", "<|endoftext|>" * 3, " \u0085 "]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 50))) for _ in range(300)]
    df = docs(spark, [(i, t, None) for i, t in enumerate([*texts, *texts[:20]])])
    tokenizer = Tokenizer.from_file(VOCABULARY)
    out = bpe.decoded(bpe.encoded(df, VOCABULARY), VOCABULARY)
    assert sorted(out.columns) == sorted(["doc_id", "lang", "n", "part", "ids", "text"])
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(texts) + 20
    for i, text in enumerate([*texts, *texts[:20]]):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert list(got[i].ids) == want
        assert got[i].text == tokenizer.decode(want, skip_special_tokens=False) == (text or "")
    empty = bpe.encoded(df.limit(0), VOCABULARY)
    assert empty.count() == 0 and bpe.decoded(empty, VOCABULARY).count() == 0


def test_bpe_decodes_any_ids(spark):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    lists = [[], [0, 50256, 1], [99999, 5, -1], [140], [247, 98, 222], [260, 140, 140], None]
    df = spark.createDataFrame(list(enumerate(lists)), "k int, ids array<int>")
    got = {r.k: r.text for r in bpe.decoded(df, VOCABULARY).collect()}
    for k, ids in enumerate(lists):
        assert got[k] == tokenizer.decode([i for i in ids or [] if 0 <= i <= 50256], skip_special_tokens=False)


def test_bpe_sections_of_a_long_text(monkeypatch):
    text = ("some words <|endoftext|> and\n\nmore  words" * 200).encode()
    data = np.frombuffer(text, np.uint8)
    vocabulary = bpe.vocabulary(VOCABULARY)
    parts = list(bpe.sections(data, 500))
    assert len(parts) > 5 and parts[0][0] == 0 and parts[-1][1] == len(data)
    ids = np.concatenate([vocabulary.encode(data[a:b], np.array([0, b - a]))[0] for a, b in parts])
    assert ids.tolist() == Tokenizer.from_file(VOCABULARY).encode(text.decode(), add_special_tokens=False).ids
    assert list(bpe.sections(np.frombuffer(b"x" * 5000, np.uint8), 500)) == [(0, 5000)]


def test_merges_take_the_lowest_rank_and_leftmost_first():
    ranks = {1 << 32 | 1: 1, 1 << 32 | 2: 0, 3 << 32 | 3: 2}
    assert bpe.merged([1, 1, 1, 2, 1], ranks, [9, 3, 8]) == [3, 9, 1]
    assert bpe.merged([1] * 5, ranks, [9, 3, 8]) == [8, 1]
    assert bpe.merged([], ranks, []) == [] and bpe.merged([4], ranks, []) == [4]


# --- collocations ------------------------------------------------------------


def plain_collocations(rows, least, limit, share=80):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        f = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(w)
            f.update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        several = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in several.items():
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            longer = [b for q, b in several.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= share * a for b in longer):
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def test_collocations_equal_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = ["a", "B", "b", "cc", "é", "z\x00", "the", "of"] + [f"w{i}" for i in range(30)]
    gaps = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", "; "]
    rows = [(i, "".join(rng.choice(vocabulary[: rng.choice([4, 8, 38])]) + rng.choice(gaps) for _ in range(rng.randint(0, 60))), rng.choice(["en", None, "und", "fr"])) for i in range(120)]
    rows += [(1, None, "en"), (2, "", None), (None, "new york city new york city", "en")] + [rows[0]] * 9
    monkeypatch.setattr(phrases, "RANK_ROWS", 40)
    for least, limit, trigger in ((3, 15, 2), (5, 2000, 16), (2, 30, 1)):
        got = phrases.collocations(docs(spark, rows), least=least, limit=limit, trigger=trigger, bits=1 << 16)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == plain_collocations(rows, least, limit)
    assert phrases.collocations(docs(spark, [])).count() == 0


def test_first_per_group_with_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"), (F.col("id") * 7919 % 3001).alias("v"))
    got = phrases.first_per_group(df, "g", [F.desc("v")], 5, rows=50).collect()
    for g in "ab":
        want = sorted((r.v for r in df.collect() if r.g == g), reverse=True)[:5]
        assert [r.v for r in sorted(got, key=lambda r: r.rank) if r.g == g] == want


# --- importance resampling ---------------------------------------------------


def plain_resampling(rows, target):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        return w, [zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    s, t = Counter(), Counter()
    for _, text, _ in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, text, _ in rows:
        w, found = features(text)
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in found)
        weight = gain // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(found), weight, score, len(w) >= 20))
    able = sorted((-r[3], r[0] is not None, r[0]) for r in out if r[4])
    return sorted(r[:4] for r in out), able[: 25 * len(able) // 100]


def test_resampling_equals_brute_force(spark):
    rng = random.Random(6)
    w = [f"w{i}" for i in range(80)] + ["É", "UPPER", "日本", "x{y"]
    rows = [(i, " ".join(rng.choice(w[: rng.choice([20, 84])]) for _ in range(rng.randint(0, 60))), "en") for i in range(200)]
    rows += [(900, None, None), (901, "", "en"), (902, "...", "en"), (5, rows[5][1], "en"), (5, rows[5][1], "en")]
    target = [" ".join(rng.choice(w[:20]) for _ in range(30)) for _ in range(10)] + [None, ""]
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, n int")
    got = importance.resampled(docs(spark, rows), bench).collect()
    want, drawn = plain_resampling(rows, target)
    assert sorted(tuple(r)[:4] for r in got) == want
    ranked = sorted((r.rank, r.score, r.doc_id) for r in got if r.rank is not None)
    assert [(-s, d is not None, d) for _, s, d in ranked] == drawn
    assert [k for k, *_ in ranked] == list(range(1, len(drawn) + 1))


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.resampled(docs(spark, []), none).count() == 0
    one = importance.resampled(docs(spark, [(None, "a b", None)]), none).collect()
    assert len(one) == 1 and one[0].rank is None and one[0].n_features == 3


# --- n-gram Jaccard join -----------------------------------------------------


def shingles(text):
    w = re.findall("[^ \t-\r]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def plain_parts(texts):
    """Component number of each text by all pairs."""
    sets = [shingles(t) for t in texts]
    part = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and part[i] != part[j]:
            old, new = part[j], part[i]
            part = [new if p == old else p for p in part]
    return sets, part


@pytest.mark.parametrize("crowd", [2, 32])
def test_joined_equals_brute_force(spark, monkeypatch, crowd):
    """Families of near copies, and many texts that share a passage of half their words and no more."""
    monkeypatch.setattr(ngram_join, "HOT_SETS", crowd)
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(40)]
    texts = [" ".join(passage + [word() for _ in range(rng.choice([6, 9, 12, 30]))]) for _ in range(60)]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([8, 30, 90]))]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [None, "", "  ", "one two", "one two", "One two three"]
    ids = [None if k % 11 == 3 else k for k in range(len(texts))]
    got = ngram_join.joined(docs(spark, [(i, t, None) for i, t in zip(ids, texts)])).collect()
    sets, part = plain_parts(texts)
    low = {}
    for i, p in zip(ids, part):
        if i is not None:
            low[p] = min(low.get(p, i), i)
    want = Counter((i, len(s), low.get(p, i) if s else i) for i, s, p in zip(ids, sets, part))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_representatives_keep_one_text_of_each_component(spark):
    a, b, c = ("one two three four five six", "seven eight nine ten eleven twelve", "a b c d e f g h")
    rows = [(5, a, "x"), (5, b, "x"), (7, a, "x"), (None, a, "x"), (None, c, "x"), (None, c, "x"), (8, "", "x"), (8, "", "x"), (9, None, "x"), (None, "", "x"), (None, "", "x")]
    out = ngram_join.representatives(docs(spark, rows))
    assert out.columns == [c.split()[0] for c in DOCS.split(", ")]
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(5, a), (5, b), (None, c), (8, ""), (9, None), (None, ""), (None, "")], key=repr)
    assert ngram_join.representatives(docs(spark, [])).count() == 0


def test_representatives_shuffle_the_texts_once(spark):
    plan = ngram_join.representatives(docs(spark, [(1, "a b c", "x"), (1, "a b c", "x")]))._jdf.queryExecution().executedPlan().toString().splitlines()
    partial = next(k for k, line in enumerate(plan) if "partial_first(text" in line)
    assert not any("Exchange" in line for line in plan[partial - 2 : partial])


def test_kept_tables_leave_no_shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {p.name for d in folders for p in Path(d).rglob("shuffle_*")}
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("n"))
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = files()
    sums = shared.kept(rows.groupBy("n").agg(F.sum("doc_id").alias("s")).orderBy("s"))
    again = shared.table(rows.groupBy("n").agg(F.sum("doc_id").alias("s")).orderBy("s"), "sums")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert sums.collect() == again.orderBy("s").collect() and sums.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)]
    links = [(min(x), max(x)) for x in links if x[0] != x[1]]
    part = {n: n for link in links for n in link}
    for x, y in links:
        old, new = max(part[x], part[y]), min(part[x], part[y])
        part = {n: new if p == old else p for n, p in part.items()}
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == part


# --- passages ----------------------------------------------------------------


def plain_removed(rows):
    """Covered bytes by all 100-byte strings; a row that repeats an id and text is no later occurrence."""
    distinct = sorted({(i is None, i, t or "") for i, t, _ in rows}, key=lambda x: (x[0], x[1] or 0))
    seen, gone = set(), {}
    for key in distinct:
        raw = key[2].encode()
        covered = bytearray(len(raw))
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                covered[k : k + 100] = b"\x01" * 100
            seen.add(raw[k : k + 100])
        gone[key[1], key[2]] = covered
    return gone


def test_removed_equals_brute_force_with_repeated_rows(spark):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    p, q = noise(300), noise(130)
    rows = [(1, noise(200) + p + noise(90), None)] * 3
    rows += [(2, noise(150) + p[40:] + q, None), (3, q + noise(20) + q, None), (4, "z" * 350, None), (5, "z" * 120, None), (6, None, None), (7, "", None)]
    rows += [(k, noise(80) + rng.choice([p, q])[: rng.randrange(60, 130)] + noise(50), None) for k in range(10, 30)]
    rows += [(None, p, None)]
    gone = plain_removed(rows)
    got = substrings.removed(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {i: t or "" for i, t, _ in rows}
    for r in got:
        raw, covered = by_id[r.doc_id].encode(), gone[r.doc_id, by_id[r.doc_id]]
        assert (r.n_bytes, r.n_removed) == (len(raw), sum(covered)), r.doc_id
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert [r.n_removed for r in got if r.doc_id == 1] == [0, 0, 0]
    assert substrings.removed(docs(spark, [])).count() == 0


# --- chat, decontamination, language, shards, neighbours -----------------------


def test_chat_ends_with_null_and_negative_turns(spark):
    rows = [(1, None, "user", "n"), (1, -5, "system", "s"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1 << 40, "user", "c")]
    rows += [(None, 0, None, None), (2, None, "tool", ""), (2, None, "user", "x")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, _id string")
    got = chat.repaired(df).collect()
    assert len(got) == len(rows)
    assert sorted((r.conv_id or 0, r.text or "") for r in got) == sorted((r[0] or 0, r[3] or "") for r in rows)
    dense = [(1, k, "user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(40)]
    df = spark.createDataFrame(dense, "conv_id long, turn long, role string, text string")
    whole, blocks = (sorted(map(tuple, chat.repaired(df, block_turns=b).collect())) for b in (512, 3))
    assert whole == blocks and all(r[4] == r[2] for r in whole)


def test_clean_judges_each_text(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    bench = spark.createDataFrame([(1, item, 0)], "item_id long, text string, mark int")
    rows = [(None, f"x {item} y", None), (None, "clean", None), (4, f"{item}", None), (4, "also clean", None), (5, None, None), (6, "", None), (7, item, None)]
    got = decontam.clean(docs(spark, rows), bench)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([(None, "clean"), (4, "also clean"), (5, None), (6, "")], key=repr)
    assert decontam.clean(docs(spark, rows), bench.limit(0)).count() == len(rows)
    assert decontam.clean(docs(spark, []), bench).count() == 0


def test_identified_writes_the_language(spark):
    rng = random.Random(2)
    words = {"aa": ["una", "casa", "grande", "perro"], "bb": ["das", "haus", "gross", "hund"]}
    rows = [(k, " ".join(rng.choice(words[lang]) for _ in range(25)), lang) for k in range(120) for lang in words]
    wrong = (5000, " ".join(["das haus gross hund"] * 5), None)
    df = docs(spark, [*rows, wrong, (5001, "12 34", "aa"), (5002, None, "aa"), (5003, "", "bb")])
    got = {r.text: r.lang for r in langid.identified(df, langid.fit(df)).collect()}
    assert got[wrong[1]] == "bb" and "12 34" not in got and "" not in got
    unlabelled = docs(spark, [(1, "text", None), (2, "12", None)])
    assert [(r.doc_id, r.lang) for r in langid.identified(unlabelled, langid.fit(unlabelled)).collect()] == [(1, None)]


def test_shards_grow_only_into_the_new_one(spark):
    df = docs(spark, [(k if k % 50 else None, f"t{k}", None) for k in range(3000)] + [(7, "t7", None)] * 3 + [(8, None, None)])
    got = sharding.sharded(df, "doc_id", "text", [1.0] * 8, [1.0] * 9).collect()
    assert len(got) == 3004
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    moved = sum(r.grown_shard == 8 for r in got) / len(got)
    assert 0.05 < moved < 0.18
    assert len({r.shard for r in got if r.doc_id == 7}) == 1
    for shard in range(8):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    weighted = Counter(r.shard for r in sharding.sharded(df, "doc_id", "text", [1.0, 3.0, 0.0]).collect())
    assert set(weighted) == {0, 1} and 2.4 < weighted[1] / weighted[0] < 3.7
    assert sharding.sharded(df.limit(0), "doc_id", "text", [1.0] * 8).count() == 0


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(2500, 12)), np.repeat(rng.normal(size=(1, 12)), 300, 0)]).astype(np.float32)
    rows = [(k, v.tolist(), "e") for k, v in enumerate(x)] + [(9000, None, "e"), (9050, [0.0] * 12, "e"), (9100, [float("nan")] * 12, "e")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = ann.search(df, df.where("vec_id % 50 = 0")).collect()
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    hits = total = 0
    for q in range(0, len(x), 50):
        score = u @ u[q]
        score[q] = -2
        best = np.sort(score)[::-1][4]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [k for k, _, _ in mine] == [1, 2, 3, 4, 5]
        for _, v, s in mine:
            assert v != q and s == pytest.approx(score[v], abs=1e-12)
        hits += sum(s >= best - 1e-9 for _, _, s in mine)
        total += 5
    assert hits / total >= 0.9
    assert {r.query_id for r in got} == set(range(0, len(x), 50))
