"""The three classifiers against plain Python, feature by feature and step by step."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from factlake.llm import langid, quality, toxicity
from factlake.llm import textvec as tv

M = 2**64 - 1
BYTE_CODE, PLACE = [int(x) for x in tv.BYTE_CODE], [int(x) for x in tv.PLACE]
STEP, MIX_A, MIX_B = int(tv.STEP), int(tv.MIX_A), int(tv.MIX_B)
SPACE = " \t\n\x0b\x0c\r"
LATIN = {**{c: c + 32 for c in range(65, 91)}, **{c: c + 32 for c in range(0xC0, 0xDF) if c != 0xD7}}


def mix(h):
    h = (h ^ h >> 30) * MIX_A & M
    h = (h ^ h >> 27) * MIX_B & M
    return h ^ h >> 31


def word_hash(word, prefix=None):
    raw = word.encode()
    h = sum(BYTE_CODE[b] * pow(STEP, k + 1, 2**64) for k, b in enumerate(raw[:prefix])) + len(raw) * MIX_A
    return mix(h & M)


def prefix_hash(word, prefix):
    return mix(sum(BYTE_CODE[b] * pow(STEP, k + 1, 2**64) for k, b in enumerate(word.encode()[:prefix])) & M)


def gram_hash(parts, width, skip=0):
    return mix(((width * 64 + skip) * 0x51ED2701 + 1 + sum(h * PLACE[k] for k, h in enumerate(parts))) & M)


def texts(n, seed):
    r = random.Random(seed)
    stock = ["der", "Haus", "the", "of", "öl", "ÉCOLE", "日本", "😀", "x", "don't", "a1", "Çava", "grobbel", "snarf", "1234", "--", "end."]
    out = ["", " ", "one", "one one", "\t a\n b", "Ünïcödé ñ"]
    return out + ["".join(r.choice(stock) + r.choice([" ", "  ", "\n", ", "]) for _ in range(r.randrange(1, 60))) for _ in range(n - len(out))]


def toxic_places(text, m):
    ws = re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", text.translate(LATIN))
    h = [word_hash(w) for w in ws]
    out = set(h) | {mix((prefix_hash(w, m.stem) + STEP) & M) for w in ws}
    out |= {gram_hash(h[k : k + 2], 2) for k in range(len(h) - 1)} | {gram_hash([h[k], h[k + 2]], 2, 1) for k in range(len(h) - 2)}
    return sorted({x >> 64 - m.bits for x in out})


def test_ftrl_as_plain_python():
    m = toxicity.Ftrl(bits=14, epochs=3, l1=0.4, least_docs=2)
    rows = texts(200, 1)
    places, row = toxicity.features(pa.array(rows), m.bits, m.stem)
    for k, t in enumerate(rows):
        assert sorted(set(places[row == k].tolist())) == toxic_places(t, m)
    sets = [toxic_places(t, m) for t in rows]
    labels = [int("grobbel" in t) for t in rows]
    many = {p for p in {p for s in sets for p in s} if sum(p in s for s in sets) >= m.least_docs}
    z, n, zb, nb = dict.fromkeys(many, 0.0), dict.fromkeys(many, 0.0), 0.0, 0.0

    def weight(z, n):
        return 0.0 if abs(z) <= m.l1 else -(z - math.copysign(m.l1, z)) / ((m.beta + math.sqrt(n)) / m.alpha + m.l2)

    order = np.random.default_rng(m.seed)
    for _ in range(m.epochs):
        for i in order.permutation(len(rows)):
            x = [p for p in sets[i] if p in many]
            wb = -zb / ((m.beta + math.sqrt(nb)) / m.alpha)
            g = 1 / (1 + math.exp(-(sum(weight(z[p], n[p]) for p in x) + wb))) - labels[i]
            for p in x:
                w = weight(z[p], n[p])
                z[p] += g - (math.sqrt(n[p] + g * g) - math.sqrt(n[p])) / m.alpha * w
                n[p] += g * g
            zb += g - (math.sqrt(nb + g * g) - math.sqrt(nb)) / m.alpha * wb
            nb += g * g
    want = {p: weight(z[p], n[p]) for p in many if weight(z[p], n[p])}
    bias = -zb / ((m.beta + math.sqrt(nb)) / m.alpha) + math.log(0.5)
    got = toxicity.fit_ftrl([np.array(s, np.int64) for s in sets], np.array(labels), m, 0.5)
    assert dict(zip(got.places.tolist(), got.values.tolist(), strict=True)) == pytest.approx(want, rel=1e-4, abs=1e-5)
    assert got.bias == pytest.approx(bias)
    scored = next(iter(toxicity._score(m, got)(iter([pa.record_batch({"doc_id": list(range(len(rows))), "text": rows})]))))
    for k, p in enumerate(scored.column(1).to_pylist()):
        assert p == pytest.approx(1 / (1 + math.exp(-(bias + sum(want.get(x, 0.0) for x in sets[k])))), abs=1e-4)


def quality_places(text, m):
    ws = re.findall(rf"[^{SPACE}]+", text)
    h = [word_hash(w) for w in ws]
    out = h + [STEP if a == b else gram_hash([a, b], 2) for a, b in zip(h[:-1], h[1:], strict=True)]
    wide = f" {text} "
    for width in m.widths:
        for k in range(len(wide) - width + 1):
            gram = wide[k : k + width]
            if any(c in SPACE for c in gram[1:-1]) or (gram[0] in SPACE and gram[-1] in SPACE):
                continue
            code = [mix(((32 if c in SPACE else ord(c)) + STEP) & M) for c in gram]
            out.append(mix((sum(c * (pow(STEP, i, 2**64) if i else 1) for i, c in enumerate(code)) + width - 1) & M))
    return [x >> 64 - m.bits for x in out]


def test_subword_sgd_as_plain_python():
    m = quality.Subword(bits=10, dim=5, epochs=2, rate=0.7)
    rows = texts(200, 2)
    kinds = quality.features(pa.array(rows), m)
    for k, t in enumerate(rows):
        got = np.concatenate([p[o[k] : o[k + 1]] for p, o in kinds])
        assert sorted(got[got >= 0].tolist()) == sorted(quality_places(t, m)), t
    rng = np.random.default_rng(m.seed)
    vectors = rng.uniform(-1 / m.dim, 1 / m.dim, (1 << m.bits, m.dim)).tolist()
    layer, bias = [[0.0] * m.dim, [0.0] * m.dim], [0.0, 0.0]
    labels = [int("日本" in t) for t in rows]
    done, steps = 0, m.epochs * len(rows)
    for _ in range(m.epochs):
        for i in rng.permutation(len(rows)):
            rate = m.rate * (1 - done / steps)
            done += 1
            x = quality_places(rows[i], m)
            if not x:
                continue
            mean = [sum(vectors[p][d] for p in x) / len(x) for d in range(m.dim)]
            out = [sum(layer[c][d] * mean[d] for d in range(m.dim)) + bias[c] for c in (0, 1)]
            e = [math.exp(o) for o in out]
            g = [e[c] / sum(e) - (c == labels[i]) for c in (0, 1)]
            back = [sum(g[c] * layer[c][d] for c in (0, 1)) for d in range(m.dim)]
            for c in (0, 1):
                layer[c] = [layer[c][d] - rate * g[c] * mean[d] for d in range(m.dim)]
                bias[c] -= rate * g[c]
            for p in x:  # the mean's derivative by a vector is one over the number of features
                vectors[p] = [vectors[p][d] - rate * back[d] / len(x) for d in range(m.dim)]
    bags = [np.unique(np.array(quality_places(t, m), np.int64), return_counts=True) for t in rows]
    got = quality.fit_sgd(bags, np.array(labels), m, 2.0)
    assert got.bias == pytest.approx(bias[1] - bias[0] + math.log(2.0), abs=1e-3)
    margin = [sum(vectors[p][d] * (layer[1][d] - layer[0][d]) for d in range(m.dim)) for p in range(1 << m.bits)]
    assert got.margin.tolist() == pytest.approx(margin, abs=1e-3)
    scored = next(iter(quality._score(m, got)(iter([pa.record_batch({"doc_id": list(range(len(rows))), "text": rows})]))))
    for t, p in zip(rows, scored.column(1).to_pylist(), strict=True):
        x = quality_places(t, m)
        assert p == pytest.approx(1 / (1 + math.exp(-(sum(margin[k] for k in x) / max(1, len(x)) + got.bias))), abs=1e-3)


def gram_counts(text, m):
    """Byte grams of the words without a digit, lower-cased; words are letters, digits and all beyond ASCII."""
    data = f" {text} ".translate(LATIN)
    data = re.sub(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+", lambda w: " " * len(w[0].encode()) if re.search("[0-9]", w[0]) else w[0], data)
    raw = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in data.encode())
    out = {}
    for width in m.widths:
        for k in range(len(raw) - width + 1):
            gram = raw[k : k + width]
            if 32 in gram[1:-1] or gram == b"  ":
                continue
            h = BYTE_CODE[gram[0]]
            for i, b in enumerate(gram[1:]):
                h += BYTE_CODE[b] * pow(STEP, i + 1, 2**64)
            h &= M
            place = ((h ^ h >> 29) * MIX_A & M) >> 64 - m.bits
            out[place] = out.get(place, 0) + 1
    return out


def test_centroids_as_plain_python():
    m = langid.Centroid(bits=9, clusters=2, rounds=3)
    rows = [t for t in texts(200, 3)]
    got = langid._counts(pa.array(rows), m)
    bags = [gram_counts(t, m) for t in rows]
    for k, bag in enumerate(bags):
        assert {p: c for p, c in enumerate(got[k].tolist()) if c} == bag, rows[k]
    used = [k for k, b in enumerate(bags) if b]
    labels = np.array(["l" + str(k % 3) for k in used], object)
    model = langid.fit_centroids([(np.array(sorted(bags[k])), np.array([bags[k][p] for p in sorted(bags[k])])) for k in used], labels, m)
    df = [sum(p in bags[k] for k in used) for p in range(1 << m.bits)]
    idf = [math.log((1 + len(used)) / (1 + d)) + 1 for d in df]
    assert model.idf.tolist() == pytest.approx(idf, rel=1e-5)

    def unit(v):
        size = math.sqrt(sum(x * x for x in v)) or 1.0
        return [x / size for x in v]

    def vector(bag):
        return unit([bag.get(p, 0) * idf[p] for p in range(1 << m.bits)])

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b, strict=True))

    centers, owner = [], []
    for name in sorted(set(labels)):
        x = [vector(bags[k]) for k, label in zip(used, labels, strict=True) if label == name]
        second = min(range(len(x)), key=lambda i: dot(x[i], x[0]))
        c = [x[0], x[second]]
        for _ in range(m.rounds):
            near = [max((0, 1), key=lambda j: dot(v, c[j])) for v in x]
            c = [unit([sum(v[p] for v, n in zip(x, near, strict=True) if n == j) for p in range(1 << m.bits)]) if j in near else c[j] for j in (0, 1)]
        centers += c
        owner += [name, name]
    scored = next(iter(langid._score(m, model)(iter([pa.record_batch({"doc_id": list(range(len(rows))), "text": rows, "letter": [True] * len(rows)})]))))
    same = 0
    for k, (name, score) in enumerate(zip(scored.column(1).to_pylist(), scored.column(2).to_pylist(), strict=True)):
        cos = [dot(vector(bags[k]), c) for c in centers]
        assert score == pytest.approx(max(cos), abs=1e-3)
        same += name == owner[int(np.argmax(cos))]
    assert same >= len(rows) - 2  # but for ties in the last digit
