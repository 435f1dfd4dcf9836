"""The operators on documents against brute force, with the hard cases."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from watchloom.llm import decontamination, language_model, packing, passages, pii, simhash, suffix_array, toxicity

LONG = "word " * 20000


# --- SimHash -----------------------------------------------------------------

def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(marked, distance):
    """doc_id -> smallest reachable id."""
    ids = [i for i, _ in marked]
    near = {i: [j for j, g in marked if (f ^ g).bit_count() <= distance] for i, f in marked}
    out = {}
    for i in sorted(ids):
        todo, seen = [i], {i}
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = min(seen)
    return out


def test_simhash_equals_brute_force(spark, sf_dir, docs):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000, None), (10_001, ""), (10_002, "one"), (10_003, " \t ÀB c\x0bd E "), (10_004, LONG)]
    frame = docs([t for _, t in rows], [i for i, _ in rows])
    got = {r["doc_id"]: r for r in simhash.near_duplicates(frame).collect()}
    marked = [(i, brute_fingerprint(t)) for i, t in rows]
    want = brute_classes(marked, 4)
    assert {i: f"{f:016x}" for i, f in marked} == {i: r["fingerprint"] for i, r in got.items()}
    assert want == {i: r["component_id"] for i, r in got.items()}


def test_simhash_large_keys_are_cut_into_blocks(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    bits = {base}
    while len(bits) < 120:  # a cloud around one value, and strangers
        bits.add(rng.choice(sorted(bits)) ^ (1 << rng.randrange(64)) if len(bits) < 80 else rng.getrandbits(64))
    frame = spark.createDataFrame([(int(np.uint64(b).astype(np.int64)),) for b in bits], "bits long")
    small = {tuple(sorted((r["a"], r["b"]))) for r in simhash.links(frame, 4, block=4).collect()}
    as_signed = {b: int(np.uint64(b).astype(np.int64)) for b in bits}
    want = brute_classes([(as_signed[b], b) for b in bits], 4)

    def classes(pairs):
        root = {v: v for v in as_signed.values()}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        return {v: find(v) for v in root}

    assert classes(small) == want


def test_simhash_ties_nulls_and_empty(spark, docs):
    got = simhash.near_duplicates(docs(["same text here now", "same text here now", None], [None, None, 3])).collect()
    assert len(got) == 3 and {r["component_id"] for r in got if r["doc_id"] is None} == {None}
    assert simhash.near_duplicates(docs([])).count() == 0


# --- passages ----------------------------------------------------------------

def brute_passages(rows):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            s = b[k:k + 50]
            first[s] = min(i, first.get(s, i))
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < i:
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_passages_equal_brute_force(spark, sf_dir, docs):
    rng = random.Random(2)
    piece = ["".join(rng.choice("ab é") for _ in range(n)) for n in (49, 50, 51, 80, 200)]
    texts = [rng.choice(piece) + "".join(rng.choice("xyzé ") for _ in range(rng.randrange(90))) + rng.choice(piece) for _ in range(40)]
    texts += ["a" * 300, "a" * 120, "ab" * 100, None, "", "short", LONG[:5000], LONG[:5000], texts[0]]
    sample = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(120).collect()
    texts += [r["text"] for r in sample]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in passages.deduplicate(docs(texts)).collect()}
    assert got == brute_passages(rows)


def test_passages_edge_rows(docs):
    text = "".join(map(str, range(100)))
    got = passages.deduplicate(docs([text, text, text], [None, 4, 4])).collect()
    assert [r["n_removed"] for r in got] == [0, 0, 0]  # no id is smaller than none, and one id takes nothing from itself
    assert passages.deduplicate(docs([])).count() == 0


def test_texts_that_share_less_than_a_string_stay_whole(docs):
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [noise(49) for _ in range(12)]
    texts = [f"{k}{noise(30)}{k}".join(["", *shared, ""]) for k in range(3)]
    assert {r["n_removed"] for r in passages.deduplicate(docs(texts)).collect()} == {0}


def test_shards_sort_only_stretches_that_another_text_shares(monkeypatch):
    rng = random.Random(5)
    noise = lambda n: bytes(rng.choice(b"abc\0 ") for _ in range(n))
    passage = noise(400)
    texts = []
    for _ in range(30):
        k = rng.randrange(400)
        texts.append(noise(rng.randrange(60)) + passage[:k] + noise(1) + passage[k + 1:] + noise(rng.randrange(60)))
    rows = [
        {"doc_id": d // 2, "digest": t, "start": max(0, p - 26), "left": min(26, p), "around": t[max(0, p - 26): p + 50]}  # two texts a document
        for d, t in enumerate(texts) for p in passages.anchors(t)[0].tolist()]
    sent = []

    class Held:
        def groupBy(self, _):
            return self

        def applyInArrow(self, f, _):
            return f

    real = passages.equal_starts
    monkeypatch.setattr(passages, "equal_starts", lambda text, *more: (sent.append(len(text)), real(text, *more)))
    found = passages.sorted_hits(Held())(pa.Table.from_pylist(rows)).to_pylist()
    got, want = set(), set()
    for r in found:
        got |= {(r["doc_id"], r["digest"], k) for k in range(r["start"], r["end"])}
    first = {}
    for d, t in enumerate(texts):
        for k in range(len(t) - 49):
            first.setdefault(t[k: k + 50], d // 2)
    for d, t in enumerate(texts):
        for k in range(len(t) - 49):
            if first[t[k: k + 50]] < d // 2:
                want |= {(d // 2, t, j) for j in range(k, k + 50)}
    assert got == want and len(want) > 1000
    assert sum(sent) < sum(len(r["around"]) for r in rows) / 3


def test_suffixes_by_induced_sorting_on_disk(tmp_path):
    rng = random.Random(1)
    for round_ in range(150):
        text = [rng.randrange(rng.choice([1, 2, 5, 300])) for _ in range(rng.choice([1, 2, 7, 60, 150]))] * rng.choice([1, 1, 3])
        order = sorted(range(len(text)), key=lambda k: text[k:])
        batches = list(suffix_array.sorted_suffixes(np.array(text), str(tmp_path), f"t{round_}", memory=rng.choice([4, 20, 10**6])))
        assert np.concatenate([p for p, _ in batches])[::-1].tolist() == order
        shared = np.concatenate([s for _, s in batches])[::-1].tolist()
        for (a, b), s in zip(zip(order, order[1:]), shared):
            k = 0
            while k < 64 and max(a, b) + k < len(text) and text[a + k] == text[b + k]:
                k += 1
            assert s == k
    assert not list(tmp_path.iterdir())


# --- personal data -----------------------------------------------------------

def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return 13 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d)) % 10 == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", luhn),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= sum(c.isdigit() for c in s) <= 15),
]


def test_base_spans_equal_the_plain_patterns(spark, sf_dir, docs):
    rng = random.Random(3)
    texts = ["".join(rng.choice("a1.@+- ()5é\n4") for _ in range(rng.choice([10, 60, 300]))) for _ in range(400)]
    texts += ["4524132264652876 x 4524-1322-6465-2876 4524  132264652876", "a@b.c_d@e.f a@b@c.d 1.2.3.4.5.6.7.8 000255.1.1.1 256.1.1.1",
              "9" * 30000, "1 2 " * 20000, "é𐍈 x@y.zz 1.2.3.4", "a." * 20000 + "@b.c", None, "", LONG]
    texts += [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for row in pii.find(docs(texts)).collect():
        found = [(k, m.start(), m.end()) for k, p, f in BASE for m in re.finditer(p, texts[row["doc_id"]] or "") if f(m.group())]
        listed = [":".join(map(str, x)) for x in found]
        assert row["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        counts = Counter(k for k, _, _ in found)
        assert [row[f"n_{k}"] for k, _, _ in BASE] == [counts[k] for k, _, _ in BASE]
        assert set(listed) <= set(row["spans"].split(",")) | {""}


def test_pii_adds_and_masks(spark, docs):
    texts = ["write to Dr. Anna Smith or call +1 (269) 555-3296 4524132264652876 now", "nothing here", None, "ssn 123-45-6789, a@b.org"]
    judged = pii.candidates(docs(texts))
    rows = {r["doc_id"]: r["text"] for r in pii.mask(judged, pii.fit(judged)).collect()}
    assert rows[1] == texts[1] and rows[2] is None
    assert "4524132264652876" not in rows[0] and "[CARD]" in rows[0]
    assert rows[3].endswith("[EMAIL]")
    assert pii.find(docs([])).count() == 0 and "FlatMap" not in judged._jdf.queryExecution().executedPlan().toString()


def test_em_trusts_labelers_that_agree():
    votes = np.array([[1, 1, 1], [-1, -1, 1], [1, 1, -1], [-1, -1, -1]], dtype=float)
    right, posterior = pii._em(votes, np.array([40, 40, 40, 40.0]), 50)
    assert right[0] > right[2] and posterior[0] > 0.9 and posterior[3] < 0.1


# --- toxicity ----------------------------------------------------------------

def test_grammar_scores_clauses():
    model = toxicity.Model({"idiot$": 1.0, "clow": 1.0})
    reader = toxicity.Reader(model)
    by = dict(zip(toxicity.EVENTS, reader.features("An idiot. You are a clown! He is not an idiot. She said idiot. I will kill you")))
    assert by == {"insult": 2.0, "negated": 1.0, "reported": 1.0, "targeted": 1.0, "threat": 1.0}
    assert reader.features("") == [0.0] * 5 and reader.score("you idiot") > reader.score("you said idiot") > reader.score("")


def test_toxicity_learns_from_labels_alone(spark, docs):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(40)) + (f" zork{rng.choice('xyz')} here zork{rng.choice('xyz')}." if k % 4 == 0 else ".") for k in range(600)]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(600)] + [(None, 1, 1), (700, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs([*texts, None, ""]), labels).collect()
    assert len(got) == 602 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 600]
    assert sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held) >= 0.95 * len(held)
    nothing = toxicity.classify(docs(texts[:3]), labels.limit(0)).collect()
    assert len(nothing) == 3 and toxicity.classify(docs([]), labels).count() == 0


# --- decontamination ---------------------------------------------------------

ITEM = "Yesterday Bob bought 5 apples for 3 dollars and then Bob sold 5 apples to him gladly"


def test_templates_find_other_numbers_and_names_if_consistent(spark, docs):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "Tiny item"), (1, ITEM)], "item_id long, text string")
    texts = [
        "Before it. " + ITEM + " And after.", "Well, Zoe bought 12 apples for 7 dollars and then Zoe sold 12 apples to him gladly",
        "Well, Zoe bought 12 apples for 7 dollars and then Max sold 9 apples to him gladly", "Nothing of the kind is said here at all", None, "",
        LONG + ITEM, "Here is a Tiny item too"]
    got = {r["doc_id"]: r for r in decontamination.report(docs(texts), items).collect()}
    assert [k for k, r in sorted(got.items()) if r["contaminated"]] == [0, 1, 6, 7]
    assert got[0]["item_ids"] == [1] and got[7]["item_ids"] == [4]
    assert decontamination.report(docs(texts), items.limit(0)).filter("contaminated").count() == 0
    assert decontamination.report(docs([]), items).count() == 0


def test_leaks_in_other_letters_and_with_other_token_counts(spark, docs):
    heading = "The Great River Crossing Of The Northern Fleet In Winter"
    long_item = "Yesterday in the town Anna bought 1200 apples and then with him Anna sold 1200 pears"
    items = spark.createDataFrame([(1, ITEM), (2, heading), (3, long_item)], "item_id long, text string")
    texts = [
        "See this. " + heading + " or so", heading.upper(), "he read " + heading.lower(), ITEM.lower(), ITEM.upper(),
        ITEM.replace("dollars and", "dollars today and"), ITEM.replace("for 3 dollars", "3 dollars"),
        long_item.replace("Anna", "Maria Lopez").replace("1200", "1 200"),
        "Yesterday Zoe Lee bought 1 2 apples for 7 dollars and then Max Lee gave 9 pears", "The Small Brook Passing Of The Southern Herd At Noon"]
    got = {r["doc_id"]: r["item_ids"] for r in decontamination.report(docs(texts), items).collect()}
    assert [got[k] for k in range(10)] == [[2], [2], [2], [1], [1], [1], [1], [3], [], []]


def test_each_new_word_is_hashed_once(monkeypatch):
    canon, seen = decontamination.Canon(), []
    real = xxhash.xxh64_intdigest
    monkeypatch.setattr(decontamination.xxhash, "xxh64_intdigest", lambda x: seen.append(x) or real(x))
    words = ["".join(p) for p in itertools.product("qxzj", repeat=4)]
    plain = canon.views(" ".join(words * 3))[1]
    assert plain.h.tolist() == [real(w) for w in words * 3] and sorted(seen) == sorted(words)


def test_many_texts_together_find_what_each_finds_alone(monkeypatch):
    rng = random.Random(8)
    heading = "The Great River Crossing Of The Northern Fleet In Winter"
    known = decontamination.index([(1, ITEM), (2, heading), (3, "Tiny item"), (4, "12 apples 5 km Bob")])
    tokens = f"{ITEM} {heading} Zoe 12 5 km . \n \x00 <text> Tiny item".split(" ")
    texts = ["", "Tiny", "item", " ".join(ITEM.split()[:3]), " ".join(ITEM.split()[3:]), "He saw Bob", "Zoe bought"]
    for _ in range(300):
        k = rng.randrange(10)
        whole = rng.choice([ITEM, heading, ITEM.replace("Bob", "Zoe"), "12 apples 5 km Bob"]).split()
        texts.append(" ".join([*(rng.choice(tokens) for _ in range(rng.randrange(6))), *whole[k: k + rng.randrange(12)]]))
    canon = decontamination.Canon()
    alone = [any(len(p) for v, own in zip(canon.views(t), known) for _, p, _ in decontamination.matches(v, own)) for t in texts]
    assert 20 < sum(alone) < 280
    for size in (1, 100, 1 << 17):
        monkeypatch.setattr(decontamination, "TOGETHER", size)
        assert decontamination.touched(texts, known, canon).tolist() == alone
    assert not any(decontamination.leaks(t, known, canon) for t, some in zip(texts, alone) if not some)


def test_benchmark_in_slices(spark):
    items = spark.createDataFrame([(k, f"text {k} " * 5) for k in range(50)], "item_id long, text string")
    held = list(decontamination.slices(items, limit=300))
    assert len(held) > 3 and sorted(i for s in held for i, _ in s) == list(range(50))


# --- packing -----------------------------------------------------------------

def test_packing_is_gapless_and_tight(spark, sf_dir, docs):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()] + [None, "", LONG, "<|endoftext|>"]
    ids = [*range(len(texts) - 2), None, 0]  # a null and a repeated id
    got = packing.pack(docs(texts, ids)).collect()
    encode = packing.Encoder(packing.tokenizer_path())
    tokens = Counter()
    for i, t in zip(ids, texts):
        tokens[i] += len(encode.reference(t or "")) + 1
    assert Counter({i: sum(r["length"] for r in got if r["doc_id"] == i) for i in set(ids)}) == tokens
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in by.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    assert len(by) <= -(-sum(tokens.values()) // packing.CAPACITY) * 1.02 + 1
    for r in got[:200]:
        if r["doc_id"] not in (None, 0):
            own = [*encode.reference(texts[r["doc_id"]] or ""), 0][r["start"]: r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(own, dtype="<u4").tobytes())
    assert packing.pack(docs([])).count() == 0


def test_encoder_equals_the_json_file():
    encode = packing.Encoder(packing.tokenizer_path())
    for text in ["", "<|endoftext|> a", "\u0000\x85　  \n\n x", "İ ı ’s 're  'S", "𐍈ᚠ٣४ⅷ½", "a" * 5000, " " * 3000, "é" * 300]:
        assert encode(text) == encode.reference(text)


def test_added_tokens_are_encoded_as_the_untouched_file_does(docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.tokenizer_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", "<|endoftext |>", "no such text", ""]
    encode = packing.Encoder(packing.tokenizer_path())
    want = {k: plain.encode(t, add_special_tokens=False).ids for k, t in enumerate(texts)}
    assert want[0] == [64, 220, 50256, 275]
    for k, t in enumerate(texts):
        assert encode(t) == encode.reference(t) == want[k]
    for r in packing.pack(docs(texts)).collect():
        own = [*want[r["doc_id"]], packing.END_ID]
        assert r["length"] == len(own) and r["ids_crc32"] == zlib.crc32(np.array(own, dtype="<u4").tobytes())


def test_running_sums(spark):
    rows = [(k, [(7 * i + k) % 11 for i in range(k)]) for k in (0, 1, 2, 3, 4, 5, 10, 99, 1000)]
    frame = spark.createDataFrame(rows, "k int, numbers array<int>")
    for r in frame.select("numbers", pii._sums(F.col("numbers")).alias("sums")).collect():
        assert r["sums"] == list(itertools.accumulate(r["numbers"]))


def test_addresses_of_a_long_text_take_time_in_proportion(spark, docs):
    def seconds(n):
        frame = docs([" ".join(f"user{k}@site{k}.example.org" for k in range(n))])
        start = time.time()
        got = frame.select(F.size(pii._located(F.col("text"), pii._EMAIL, "email")).alias("n")).first()["n"]
        assert got == n
        return time.time() - start

    seconds(100)
    assert seconds(40_000) < 12 * seconds(5_000) + 2


def test_prefixes_beyond_the_cap_are_refused(tmp_path):
    with pytest.raises(ValueError, match="up to"):
        suffix_array.equal_starts(np.arange(100), suffix_array.CAP + 1, str(tmp_path), print)


def test_plan_places_every_piece_once():
    rng = random.Random(6)
    for _ in range(60):
        capacity = rng.choice([5, 12, 40])
        counts = {k: rng.randrange(1, 30) for k in rng.sample(range(1, capacity + 1), rng.randrange(1, capacity))}
        used, ranks = {}, {k: set() for k in counts}
        for length, low, high, first, offset in packing.plan(counts, capacity):
            ranks[length].update(range(low, high))
            for k in range(high - low):
                used.setdefault(first + k, []).append((offset, length))
        assert all(ranks[k] == set(range(n)) for k, n in counts.items())
        for placed in used.values():
            end = 0
            for offset, length in sorted(placed):
                assert offset == end
                end += length
            assert end <= capacity


# --- language model ----------------------------------------------------------

def test_base_scores_equal_brute_force(spark, docs):
    rng = random.Random(8)
    words = ["the", "The", "of", "Ä", "x1", *("w%d" % k for k in range(60))]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(120)] + [None, "", "\t\n ", LONG]
    got = language_model.score(docs(texts)).collect()
    tokens = {i: (t or "").encode().lower().split() + ["end"] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for r in got:
        ws = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), n)
        assert r["n_known"] == sum(c[w] > 0 for w in ws) and r["score"] < 0
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel_tol=1e-9)
    assert language_model.score(docs([])).count() == 0
    only = language_model.score(docs(["a b"], [5 if zlib.crc32(b"5") % 5 == 1 else next(k for k in range(99) if zlib.crc32(str(k).encode()) % 5 == 1)])).first()
    assert only["train_tokens"] == 0 and only["base_score"] == 0 and only["score"] == 0


def backoff_model(train, order):
    """The model as a recursion over counts, and its vocabulary."""
    n = Counter(w for t in train for w in t[1:])
    total = sum(n.values())
    counts = Counter({(w,): c for w, c in n.items()}) + Counter({(b"\r",): len(train)})
    for k in range(2, order + 1):
        found = Counter(tuple(t[i:i + k]) for t in train for i in range(len(t) - k + 1))
        counts.update({g: c for g, c in found.items() if c > 1})
    after = {}
    for g in counts:
        if len(g) > 1:
            after.setdefault(g[:-1], []).append(counts[g])

    def p(context, w):
        if not context:
            return (n[w] + 0.5) / (total + 0.5 * (len(n) + 1))
        g, seen = (*context, w), after.get(context)
        if not seen:
            return p(context[1:], w)
        free = max(1e-12, 1 - sum(c - 0.75 for c in seen) / counts[context])
        return (counts[g] - 0.75) / counts[context] + free * p(context[1:], w) if g in counts else free * p(context[1:], w)

    return p, n


def random_texts(seed):
    rng = random.Random(seed)
    words = ["w%d" % min(rng.randrange(1, 40), rng.randrange(1, 40)) for _ in range(40)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(25))) + f" once{k}" * (k % 3) for k in range(150)]
    return [*texts, None, "", texts[7], texts[7]]


@pytest.mark.parametrize("order, block_bytes, bucket_tokens", [(3, 1 << 24, 1 << 19), (3, 300, 40), (3, 1, 7), (1, 900, 300), (2, 900, 300), (4, 900, 300)])
def test_scores_equal_the_recursion(spark, docs, order, block_bytes, bucket_tokens):
    """Whatever the size of blocks and buckets; with small buckets most contexts are dealt over several of them."""
    texts = random_texts(4)
    tokens = [[b"\r", *(t or "").encode().split(), b"\n"] for t in texts]
    p, _ = backoff_model([t for i, t in enumerate(tokens) if zlib.crc32(str(i).encode()) % 5 != 1], order)
    got = language_model.score(docs(texts), order=order, block_bytes=block_bytes, bucket_tokens=bucket_tokens).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    for r in got:
        t = tokens[r["doc_id"]]
        want = sum(math.log10(p(tuple(t[max(0, i - order + 1):i]), t[i])) for i in range(1, len(t)))
        assert math.isclose(r["score"], want, rel_tol=1e-9), r


def test_the_model_is_a_distribution_in_every_state():
    train = [[b"\r", *(t or "").encode().split(), b"\n"] for t in random_texts(5)]
    p, n = backoff_model(train, 3)
    for context in [(), (b"\r",), *{tuple(t[i:i + 2]) for t in train[:20] for i in range(len(t) - 2)}]:
        assert math.isclose(sum(p(context, w) for w in [*n, b"never seen"]), 1, rel_tol=1e-9), context


def test_repeated_rows_and_rows_without_an_id_are_each_scored(spark, docs):
    rows = language_model.score(docs(["a b", "a b", "a b", "a  B", None], [None, 7, 7, 8, None])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]) for r in rows) == [
        (False, 7, 3), (False, 7, 3), (False, 8, 3), (True, 0, 1), (True, 0, 3)]
    assert len({r["score"] for r in rows if r["n_tokens"] == 3}) == 1


def test_packed_numbers_come_back():
    for values in ([], [0], [1, 255, 256], [2 ** 64 - 1, 0], range(3000)):
        values = np.array(values, dtype=np.uint64)
        assert (language_model._unpack(language_model._pack(values)) == values).all()


def test_a_large_corpus_keeps_what_occurs_twice(spark, docs):
    texts = ["x " * 300_000] * 8 + ["alpha beta", "alpha beta", "alpha beta"]
    ids = [k for k in range(60) if zlib.crc32(str(k).encode()) % 5 != 1][:10] + [next(k for k in range(60) if zlib.crc32(str(k).encode()) % 5 == 1)]
    held = next(r for r in language_model.score(docs(texts, ids)).collect() if r["held_out"])
    assert held["train_tokens"] > 2_000_000 and held["n_tokens"] == 3
    # "alpha" after the start has 2 of 10; "beta" after it and the end after both have 2 of 2, less the discount, at two orders.
    assert -1.5 < held["score"] < -0.5 and held["base_score"] < -15
