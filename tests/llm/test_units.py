"""The operators' kernels against brute force, without Spark."""

import ctypes
import random
import resource
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waybill.llm import chat, decontam, langid, ngram_join, packing, shared, substrings, tokens, toxicity, warc, words

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def plain_words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    out, now = [], ""
    for c in folded:
        if c in " \t\n\x0b\x0c\r":
            out += [now] * bool(now)
            now = ""
        else:
            now += c
    return out + [now] * bool(now)


def plain_shingles(text):
    w = plain_words(text)
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])


TEXTS = st.lists(st.text("abA É\n\t\x0b\xa0.", max_size=60), max_size=8)


@given(TEXTS)
@settings(max_examples=150, deadline=None)
def test_words_and_shingles(texts):
    data, offsets = words.utf8(pa.array(texts, pa.string()))
    start, end, first = words.word_spans(data, offsets)
    raw = data.tobytes()
    for k, text in enumerate(texts):
        mine = [raw[s:e].decode() for s, e in zip(start[first[k] : first[k + 1]], end[first[k] : first[k + 1]])]
        assert [plain_words(m)[0] for m in mine] == plain_words(text)
    hashes, begin = words.shingle_hashes(*words.word_hashes(data, offsets))
    seen = {}
    for k, text in enumerate(texts):
        theirs = plain_shingles(text)
        assert begin[k + 1] - begin[k] == len(theirs)
        for h, s in zip(hashes[begin[k] : begin[k + 1]].tolist(), theirs):
            assert seen.setdefault(h, s) == s
    assert len(set(seen.values())) == len(seen)


def test_slices_bound_and_cover():
    offsets = np.array([0, 3, 3, 50, 52, 53])
    parts = list(words.slices(offsets, 10))
    assert [x for a, b in parts for x in range(a, b)] == list(range(5))
    assert all(b - a == 1 or offsets[b] - offsets[a] <= 10 for a, b in parts)
    assert list(words.slices(np.zeros(1, np.int64))) == []


@given(st.lists(st.integers(1, 4), max_size=60))
@settings(max_examples=300, deadline=None)
def test_suffix_array(symbols):
    text = symbols + [0]
    assert substrings.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_anchors_agree_on_equal_strings():
    rng = random.Random(1)
    shared = bytes(rng.choice(b"abc ") for _ in range(100))
    left = bytes(rng.choice(b"abc ") for _ in range(500)) + shared + b"x" * 30
    right = b"y" * 77 + shared + bytes(rng.choice(b"abc ") for _ in range(300))
    found = []
    for text in (left, right):
        data = np.frombuffer(text, np.uint8)
        at = substrings.anchors(data, words.prefix_hash(data, substrings._CODES)) - text.index(shared)
        found.append({int(x) for x in at if 0 <= x <= 84})
    assert found[0] & found[1]


def test_pretokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    whole, mine = Tokenizer.from_file(VOCABULARY), tokens.Encoder(VOCABULARY)
    rng = random.Random(4)
    parts = list("ab'stredlvm S'  \n\t.,!?12é中　 -_\U0001f600’\r") + ["'s", "'ll", " '", "  ", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["", " ", "\n\n"]
    ids, first = mine.encode(*words.utf8(pa.array(texts)))
    for k, theirs in enumerate(whole.encode_batch(texts, add_special_tokens=False)):
        assert ids[first[k] : first[k + 1]].tolist() == theirs.ids


@given(st.dictionaries(st.integers(1, 63), st.integers(1, 5), max_size=12))
@settings(max_examples=200, deadline=None)
def test_closest_sum_is_best(counts):
    target = 64
    best, sums = packing.closest(counts, target), {0}
    for length, n in counts.items():
        sums |= {s + k * length for s in sums for k in range(1, n + 1) if s + k * length <= target}
    assert sum(k * n for k, n in best.items()) == max(sums)
    assert all(n <= counts[k] for k, n in best.items())


@given(st.dictionaries(st.integers(1, 63), st.integers(1, 40), max_size=20), st.sampled_from([None, 0, 3]))
@settings(max_examples=200, deadline=None)
def test_plan_covers_every_token_once(counts, patterns):
    layout = packing.plan(counts, 64, patterns)
    places, filled = packing.Places(layout), {}
    for length, n in counts.items():
        for rank in range(n):
            at = 0
            for start, size, sequence, offset in places.of(length, rank):
                assert start == at and size > 0
                at += size
                filled.setdefault(sequence, []).append((offset, size))
            assert at == length
    assert sorted(filled) == list(range(layout.sequences))
    for spans in filled.values():
        spans.sort()
        total = sum(size for _, size in spans)
        assert [o for o, _ in spans] == [sum(s for _, s in spans[:k]) for k in range(len(spans))]
        assert total <= 64 and total & (total - 1) == 0


def test_plan_does_not_grow_with_documents():
    rng = random.Random(2)
    sizes = [len(packing.plan({k: rng.randint(1, top) for k in range(1, 256)}, 256).rows) for top in (10**4, 10**9)]
    assert sizes[1] < 2 * sizes[0]


def cheapest(roles, costs):
    """Least cost over all ways to label the turns, by enumeration."""
    from itertools import product

    step, end = chat.moves(costs), chat.ending(costs)
    best = np.inf
    for way in product(range(1, 4), repeat=len(roles)):
        total, last = 0.0, chat.START
        for code, now in zip(roles, way):
            total += step[last, now] + chat.labels(code, costs)[now]
            last = now
        best = min(best, total + end[last])
    return best if roles else 0.0


@pytest.mark.parametrize("roles", ["u", "ua", "uu", "a", "as", "sua", "ssaa", "uaau", "?", "uu?a", "asuaus"])
def test_role_repair_is_cheapest(roles):
    costs = chat.Costs()
    ends = chat.block_matrix(roles, costs)[chat.START] + chat.ending(costs)
    assert ends.min() == cheapest(roles, costs)
    leave = int(ends.argmin())
    way = chat.block_roles(roles, chat.START, leave, costs)
    step = chat.moves(costs)
    assert sum(step[a, b] + chat.labels(c, costs)[b] for a, b, c in zip(way, way[1:], roles)) == ends.min() - chat.ending(costs)[leave]
    for cut in range(1, len(roles)):
        parts = [chat.block_matrix(roles[:cut], costs), chat.block_matrix(roles[cut:], costs)]
        assert (chat.product(parts) == chat.block_matrix(roles, costs)).all()


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    from itertools import product

    for n in (1, 2, 5, 9):
        e, pairs = rng.normal(size=n) * 2, rng.normal(size=(2, 2))
        weights = np.zeros(n)
        total = 0.0
        for way in product((0, 1), repeat=n):
            w = np.exp(sum(e[i] for i in range(n) if way[i]) + sum(pairs[a, b] for a, b in zip(way, way[1:])) + np.log(np.exp(pairs[:, way[0]]).sum()))
            total += w
            weights += w * np.array(way)
        assert np.allclose(toxicity.marginals(e, np.array([0, n]), pairs), weights / total)


def test_marginals_of_long_rows_do_not_depend_on_blocks():
    rng = np.random.default_rng(6)
    e, pairs = rng.normal(size=1000), rng.normal(size=(2, 2))
    whole = toxicity.marginals(e, np.array([0, 700, 700, 1000]), pairs)
    assert np.allclose(whole[:700], toxicity.marginals(e[:700], np.array([0, 700]), pairs))
    assert np.allclose(whole[700:], toxicity.marginals(e[700:], np.array([0, 300]), pairs))
    assert toxicity.marginals(np.zeros(0), np.array([0, 0]), pairs).size == 0


def test_field_learns_words_and_stems():
    rng = random.Random(7)
    plain = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    bad = ["grobian", "wicht"]

    def text(toxic):
        out = [rng.choice(plain) for _ in range(60)]
        if toxic:
            out[rng.randrange(60)] = rng.choice(bad) + rng.choice(["", "en", "lein"])
        return " ".join(out)

    labels = [k % 2 for k in range(400)]
    field = toxicity.train(*words.utf8(pa.array([text(t) for t in labels])), np.array(labels))
    test = [k % 2 for k in range(200)]
    score, spans = toxicity.score(field, *words.utf8(pa.array([text(t) for t in test])))
    assert ((score >= 0.7) == np.array(test, bool)).mean() > 0.97
    assert all(len(s) == 1 for s, t in zip(spans, test) if t and s)


def test_languages_within_families():
    rng = random.Random(8)
    stems = {"aa": "kato", "ab": "katu", "ba": "ziwe", "bb": "ziwi"}

    def text(lang):
        return " ".join("".join(rng.choice(stems[lang]) for _ in range(5)) for _ in range(30))

    labels = [x for x in stems for _ in range(40)]
    profiles = np.array([langid.profile(text(x).encode()) for x in labels])
    model = langid.train(labels, profiles)
    assert sorted(model.groups) == [["aa", "ab"], ["ba", "bb"]]
    test = [x for x in stems for _ in range(20)]
    data, offsets = words.utf8(pa.array([text(x) for x in test]))
    names, score = langid.decide(model, langid.margins(model, data, offsets))
    assert (names == np.array(test, object)).mean() > 0.97
    assert ((score > 0) & (score <= 1)).all()
    assert langid.train([], np.empty((0, 1 << langid.BITS))).groups == []


def test_set_keys_meet_for_all_similar_sets():
    rng = np.random.default_rng(9)
    for trial in range(300):
        n = int(rng.integers(1, 60)) if trial % 2 else int(rng.integers(60, 700))
        base = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        drop = rng.integers(0, max(1, n // 7) + 1)
        other = np.append(base[drop:], rng.integers(1, 1 << 63, int(rng.integers(0, n // 9 + 1)), dtype=np.uint64))
        if not len(other):
            continue
        values = [np.unique(base), np.unique(other)]
        common = len(np.intersect1d(*values))
        similar = 100 * common >= 75 * (len(values[0]) + len(values[1]) - common)
        s = ngram_join.Sets(np.arange(2), np.concatenate(values), np.array([0, len(values[0]), len(values[0]) + len(values[1])]), np.array([1, 2]))
        slack, extra = ngram_join.allowances(s)
        sets, keys, role = ngram_join.keys_of(s, extra)
        own = [dict(zip(keys[sets == k].tolist(), role[sets == k].tolist())) for k in (0, 1)]
        shared = [(own[0][k], own[1][k]) for k in own[0].keys() & own[1].keys()]
        big = int(len(values[1]) > len(values[0]))
        met = sum(1 for r in shared if r[big] > ngram_join.INDEX and r[1 - big] & ngram_join.INDEX)
        if similar:
            band = ngram_join.band_of(np.array([len(v) for v in values]))
            assert met > slack[big][int(band[big] != band[1 - big])]


def test_containment_candidates_find_items():
    rng = random.Random(10)
    vocabulary = ["w%d" % k for k in range(5000)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (3, 6, 9, 20, 38, 57, 200)]
    parts = list(decontam._row_shingles(*words.utf8(pa.array(items)), 5))
    index = decontam.Items(list(range(len(items))), [w for w, _ in parts], [np.unique(h) for _, h in parts], 5)
    for k, item in enumerate(items):
        text = " ".join(rng.choice(vocabulary) for _ in range(9000)) + " " + item.upper().replace("W", "w") + " " + " ".join(rng.choice(vocabulary) for _ in range(777))
        found = list(decontam.search(*words.utf8(pa.array([text, "", "w1"])), index, 0.75))
        assert found == [(0, k, 1.0)]


def test_warc_members_round_trip(tmp_path):
    from pyarrow import fs

    rows = [
        {"record_id": str(k), "record_type": "revisit" if k % 3 else "response", "target_uri": "http://x/\r\ny" if k == 4 else None,
         "date": "d", "refers_to": "7" if k % 3 else None, "payload_digest": "f", "payload_length": k, "payload": None if k % 3 else random.Random(k).randbytes(k * 700)}
        for k in range(40)
    ]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(warc.member(r) for r in rows))
    size, found = path.stat().st_size, []
    for at in range(0, size, 5000):
        tape = warc.Tape(fs.LocalFileSystem(), str(path), at)
        if warc._align(tape, min(at + 5000, size)):
            found += list(warc.records(tape, min(at + 5000, size), []))
    assert [r["record_id"] for r in found] == [r["record_id"] for r in rows]
    assert all(r["payload"] == (o["payload"] or b"") for r, o in zip(found, rows))
    assert found[4]["target_uri"] == "http://x/%0D%0Ay"
    import gzip

    plain = tmp_path / "b.warc.gz"
    plain.write_bytes(b"".join(gzip.compress(gzip.decompress(warc.member(r))) for r in rows))
    tape = warc.Tape(fs.LocalFileSystem(), str(plain), 0)
    assert [r["payload"] for r in warc.records(tape, plain.stat().st_size, [])] == [o["payload"] or b"" for o in rows]


def test_crc_of_ids_is_of_little_endian_words():
    assert zlib.crc32(np.array([1, 2], "<u4").tobytes()) == zlib.crc32(b"\1\0\0\0\2\0\0\0")


def _resident() -> int:
    return int(Path("/proc/self/statm").read_text().split()[1]) * resource.getpagesize()


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="the C library cannot give memory back")
@pytest.mark.parametrize("ends", ["whole", "early"])
def test_lean_body_gives_freed_memory_back(ends):
    after = []

    def body(batches):
        rows = [bytearray(20_000) for _ in range(10_000)]
        after.append(rows[-1])  # what lives on top of the heap keeps all below it
        yield from batches

    run = shared.lean(body)(iter([1, 2]))
    assert next(run) == 1
    full = _resident()
    if ends == "early":
        run.close()
    else:
        assert list(run) == [2]
    assert full - _resident() > 100_000_000


def test_texts_are_cut_to_small_slices_for_shingles_and_languages(monkeypatch):
    texts = [f"a b c d e f {i} " * 4000 for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(40)), "text": pa.array(texts)})
    seen = []
    function = lambda batch, a, b, s: iter([(a, b, len(s.rows))])
    whole = ngram_join.sets_of
    monkeypatch.setattr(ngram_join, "sets_of", lambda data, offsets: seen.append(len(data)) or whole(data, offsets))
    found = list(ngram_join._batches([batch], function))
    assert [f[0] for f in found] == [0] + [f[1] for f in found[:-1]] and found[-1][1] == 40
    assert sum(f[2] for f in found) == 40
    assert max(seen) <= 1 << 19 and sum(seen) == sum(map(len, texts))


def test_passages_are_sought_in_small_slices():
    class Scan:
        def mapInArrow(self, body, schema):
            self.body = body
            return self

        groupBy = applyInArrow = lambda self, *args: self

    texts = ["".join(random.Random(i).choices("abcdefgh ", k=50_000)) for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"doc": pa.array(range(40)), "mark": pa.array(range(40)), "text": pa.array(texts)})
    scan = substrings.located(Scan(), 1).body
    list(scan([batch.slice(0, 1)]))  # the powers are there from now on
    tracemalloc.start()
    (packed,) = scan([batch])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    doc = substrings._unpack(packed, [np.int64, np.int64, np.uint32, np.uint64, np.int64, np.uint8, np.uint8])[0]
    assert set(doc.tolist()) == set(range(40))
    assert peak < 50_000_000


def test_encoder_loads_the_tokenizer_for_special_tokens_only():
    from tokenizers import Tokenizer

    mine = tokens.Encoder(VOCABULARY)
    for text, needed in (("some words", False), ("some <|endoftext|> words", True)):
        ids, _ = mine.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids
        assert ("whole" in vars(mine)) is needed


def test_powers_are_as_long_as_small_slices_need(monkeypatch):
    monkeypatch.setattr(words, "_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    short = [p.copy() for p in words.powers(1000)]
    assert len(words._powers[0]) == words.SMALL_SLICE_BYTES + 1
    for one, other in zip(short, words.powers(words.SLICE_BYTES + 1)):
        assert len(other) == words.SLICE_BYTES + 1 and (one == other[:1000]).all()


def test_training_on_spare_profiles_takes_no_copy_and_gives_the_same_machines():
    random_ = np.random.default_rng(3)
    labels = [("ab", "cd", "ef")[i % 3] for i in range(60)]
    profiles = random_.random((60, 1 << langid.BITS)).astype(np.float32) + np.eye(3, 1 << langid.BITS, dtype=np.float32)[np.arange(60) % 3]
    kept = profiles.copy()
    one = langid.train(labels, profiles)
    assert (profiles == kept).all()
    tracemalloc.start()
    two = langid.train(labels, profiles, spare=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert one.groups == two.groups and one.pairs == two.pairs
    for name in ("tables", "bias", "slope"):
        assert (getattr(one, name) == getattr(two, name)).all()
    assert peak < 2.6 * profiles.nbytes
