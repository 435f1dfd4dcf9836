"""Licence scan, divergence audit and VA-file clustering against plain versions and on hard cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from watchloom.llm import divergence, licences, vafile


# --- licences ------------------------------------------------------------------


def plain_licences(text, templates):
    """All windows against all templates, with sets of words."""
    words = [w.decode() for w in licences.words_of((text or "").encode())]
    starts, base = [], set()
    for phrase, label in templates.phrases:
        phrase = [w.decode() for w in phrase]
        for i in range(len(words) - len(phrase) + 1):
            if words[i: i + len(phrase)] == phrase:
                starts.append(i)
                base.add(label)
    name = {n: w.decode() for w, n in templates.numbers.items()}
    found, most = set(base), 0.0
    for span in {r[2] for r in templates.rows}:
        for at in range(0, len(words), span):
            window = set(words[at: at + 2 * span])
            best = {}
            for label, family, s, numbers, need in templates.rows:
                shared = len(window & {name[n] for n in numbers})
                if s == span and shared >= need:
                    best[family] = max(best.get(family, (0, 0, "")), (shared / len(numbers), shared, label))
            found |= {b[2] for b in best.values()}
            most = max([most, *(b[0] for b in best.values())])
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(found)),
            1.0 if starts else most)


def as_rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_licences_equal_all_pairs(docs):
    rng = random.Random(7)
    templates = licences.Templates()
    filler = "the of and this work code software is under license terms über water".split()
    texts = [None, "", " ", "GNU General Public License", "cc by cc by", "MIT license\x00apache license", "Äpache license APACHE LICENSE"]
    for _, _, notice in licences.NOTICES:
        words = notice.split()
        for drop in (0.0, 0.1, 0.2, 0.35):
            kept = [w for w in words if rng.random() >= drop]
            before, after = (" ".join(rng.choices(filler, k=rng.randrange(90))) for _ in range(2))
            texts.append(f"{before}\n{' '.join(kept)}\n{after}")
    texts += [texts[20], texts[20], "This work " * 3000 + licences.NOTICES[9][2] + " the end" * 3000]
    got = as_rows(licences.find(docs(texts)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
    want = sorted([(i, *plain_licences(t, templates)) for i, t in enumerate(texts)], key=repr)
    assert got == want
    assert sum(bool(r[6]) for r in got) > len(licences.NOTICES) * 2


def test_licences_of_null_ids_repeats_and_nothing(docs):
    found = licences.find(docs(["mit license", "mit license", None], ids=[None, None, 5]))
    assert [r["labels"] for r in found.orderBy("doc_id").collect()] == ["mit", "mit", ""]
    assert licences.find(docs([])).collect() == []


def test_licence_notices_have_their_labels(docs):
    texts = [n for _, _, n in licences.NOTICES]
    got = {r["doc_id"]: r["labels"].split(",") for r in licences.find(docs(texts)).collect()}
    assert all(label in got[i] for i, (label, _, _) in enumerate(licences.NOTICES))
    assert "gpl-2.0" not in got[1] and "cc-by-4.0" not in got[20]


def test_long_texts_are_read_in_one_pass(docs, monkeypatch):
    text = "some words here " * 50 + "apache license"
    whole = as_rows(licences.find(docs([text])))
    monkeypatch.setattr(licences, "_LONG", 10)
    assert as_rows(licences.find(docs([text]))) == whole


# --- divergence ----------------------------------------------------------------


def plain_divergence(rows, top=200):
    docs_of, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        counts[lang, source].update(found)
        docs_of[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs_of[lang].items() if n >= 3]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 1) // (total + len(kept)) for t in kept}

        share = {s: shares(counts[lang, s]) for s in sources}
        every = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept), o) for o in sources - {s}]
            terms = [((share[s][t] - every[t]) ** 2 // every[t], t) for t in kept if counts[lang, s][t] and share[s][t] > every[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])]
    return sorted(out)


def divergence_rows():
    rng = random.Random(3)
    words = ["Wasser", "éa", "née", "fin", "x1y", "Ωmega", "ω", *(f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300))]
    rows = [(None, None, None), ("", "en", "empty"), ("only once", "xx", "a"), (None, "xx", "b"), ("lone lone", None, "z")]
    for k in range(260):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["hot"] * 8 + ["a", "b", "ä", "", None, "c d"])
        rows.append((" ".join(rng.choices(words[: rng.choice([20, 307])], k=rng.randrange(40))), lang, source))
    return [*rows, *rows[40:44], ("wab " * 50_000, "de", "a")]


@pytest.mark.parametrize("terms, tile", [(64, 512), (5, 2)])
def test_divergence_equals_all_pairs(spark, monkeypatch, terms, tile):
    monkeypatch.setattr(divergence, "TERMS", terms)
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "_HELD", 50)
    rows = divergence_rows()
    frame = spark.createDataFrame([(*r, None, 1) for r in rows], "text string, lang string, source string, doc_id long, n int")
    got = sorted(tuple(r) for r in divergence.audit(frame).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == plain_divergence(rows)


def test_divergence_of_nothing(spark, docs):
    assert divergence.audit(docs([])).collect() == []


def test_joint_prices_are_those_of_single_terms(monkeypatch):
    monkeypatch.setattr(divergence, "_ROWS", 3)
    monkeypatch.setattr(divergence, "MOST_TERMS", 7)
    rng = np.random.default_rng(1)
    a, b = (rng.choice([1, 5, 2_000_000, 1_000_000_001], (n, 30)) for n in (4, 6))
    forth, back = divergence.joint_prices(a, b)
    gap = (a[:, None, :] - b[None, :, :]) ** 2
    assert (forth == (gap // b[None]).sum(axis=2)).all() and (back == (gap // a[:, None]).sum(axis=2)).all()


# --- clustering ------------------------------------------------------------------


def plain_clusters(rows, k, rounds):
    kept = [(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    started = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in started[:k]]
    for step in range(rounds + 1):
        at = [min(range(len(centroids)), key=lambda c: (sum((x - y) ** 2 for x, y in zip(v, centroids[c])), c)) for _, v in kept]
        if step < rounds:
            for c in range(len(centroids)):
                mine = [v for (_, v), a in zip(kept, at) if a == c]
                if mine:
                    centroids[c] = tuple(sum(x) // len(mine) for x in zip(*mine))
    far = [sum((x - y) ** 2 for x, y in zip(v, centroids[a])) for (_, v), a in zip(kept, at)]
    per = Counter()
    for a, d in zip(at, far):
        per[a] += d
    return sorted([(i, a, d, per[a], sum(far), hashlib.sha256(",".join(map(str, centroids[a])).encode()).hexdigest())
                   for (i, _), a, d in zip(kept, at, far)], key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "c", 0) for i, v in rows], "vec_id long, embedding array<double>, cluster string, row int")


@pytest.mark.parametrize("bits", [1, 4, 6, 8])
def test_clusters_equal_plain_rounds(spark, bits):
    rng = np.random.default_rng(5)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(150, 64)) + rng.integers(0, 3, (150, 1)) * 2)]
    rows += [(7, rows[7][1]), (8, rows[9][1]), (None, rows[3][1]), (900, [0.0] * 64), (901, [100000.0] * 64), (902, None), (903, [0.5] * 63),
             (904, [None, *[0.5] * 63]), (905, [float("nan")] * 64), (906, [float("inf")] * 64), (907, [-1e-300] * 64)]
    got = sorted([tuple(r) for r in vafile.cluster(vectors(spark, rows), k=9, rounds=3, bits=bits).collect()], key=repr)
    assert got == plain_clusters(rows, 9, 3)


def test_fewer_vectors_than_centroids_equal_ones_and_none(spark):
    rows = [(k, [0.25 * (k % 2)] * 64) for k in range(6)]
    got = sorted([tuple(r) for r in vafile.cluster(vectors(spark, rows)).collect()], key=repr)
    assert got == plain_clusters(rows, 40, 5)
    assert vafile.cluster(vectors(spark, [(1, None)])).collect() == []


def test_components_that_do_not_fit_are_refused(spark):
    with pytest.raises(Exception, match="would not fit"):
        vafile.cluster(vectors(spark, [(1, [1e300] * 64), (2, [0.0] * 64)])).collect()


def test_intervals_hold_the_distance_and_spare_fetches(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(-300, 300, (500, 64))
    centroids = rng.integers(-100, 100, (7, 64))
    cells = vafile.Cells(values[:100], values.min(axis=0), values.max(axis=0), 4)
    packed = vafile.packed(cells.cell(values), 4)
    least, greatest = vafile.bounds(vafile.unpacked(packed, 64, 4), cells.tables(centroids))
    mean = centroids.sum(axis=0) // 7
    true = ((values[:, None] - centroids[None]) ** 2).sum(axis=2) - ((values - mean) ** 2).sum(axis=1)[:, None]
    assert len(packed[0]) == 32 and (least <= true).all() and (true <= greatest).all()
    near = spark.createDataFrame([(k, ((k % 5) * 10 + rng.normal(size=64)).tolist()) for k in range(400)], "vec_id long, embedding array<double>")
    rows = vafile.quantised(near)
    points = np.array([r["parts"] for r in rows.collect()])
    cells = vafile.Cells(points, points.min(axis=0), points.max(axis=0), 6)
    five = np.stack([points[np.arange(400) % 5 == c].sum(axis=0) // 80 for c in range(5)])
    seen = vafile.narrowed(vafile.approximations(rows, cells, 64), cells, five).collect()
    assert all(bin(int.from_bytes(r["left"])).count("1") == 1 for r in seen)
