"""Classifiers, tokenizers, media and chat against libraries, brute force and held-out accuracy."""

import hashlib
import io
import random
import re
import struct
import tarfile
import zlib

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyarrow import fs

from factlake.llm import chat, langid, media, quality, sentencepiece_fst, token_store, toxicity
from factlake.llm.queries import tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, score string, label string, tokens string, n_tokens string"
ODD = [
    (1, "Hello, world! It's  the 'end' they're 12 345 %%% !!"), (2, None), (3, ""), (4, " \n\t "), (5, "  a"), (6, "é 日本 語 😀 a\u0085b   c d"),
    (7, "x <|endoftext|> y <s> </s> <unk>"), (8, "a "), (9, "▁x ▁ y▁ z"), (10, "!!! ... ***"), (11, "word " * 20_000), (12, "Hello, world! It's  the 'end' they're 12 345 %%% !!"), (12, "same id"),
]


def table(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, "s", "x", "y", "z", "n") for i, t in rows], SCHEMA)


def crc(i):
    return zlib.crc32(str(i).encode())


def labelled(spark, n=700):
    r = random.Random(1)
    common = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("a", "e", "io", "ou")]
    rows, marks = [], []
    for k in range(n):
        ws = [r.choice(common) + r.choice(common) for _ in range(r.randrange(5, 90))]
        toxic, good = k % 5 == 0, k % 3 != 0
        if toxic:
            for _ in range(2):
                ws.insert(r.randrange(len(ws)), r.choice(["grobbel", "snarfy,", "Zunk!"]))
        if not good:
            ws = [w.upper() + "!!" if r.random() < 0.7 else w for w in ws]
        rows.append((k, " ".join(ws)))
        marks.append((k, int(good), int(toxic)))
    marks += [(0, None, None), (5, int(5 % 3 != 0), 1), (99_999, 1, 1)]
    return table(spark, rows + [(50_000 + i, t) for i, t in ODD]), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int"), {m[0]: m for m in marks[: -3]}


@pytest.mark.parametrize(("operator", "column", "cut"), [(toxicity.toxicity, 2, 0.5), (quality.quality, 1, 0.3)])
def test_classifiers(spark, operator, column, cut):
    docs, labels, marks = labelled(spark)
    got = {r["doc_id"]: r for r in operator(docs, labels).collect()}
    assert len(got) == 700 + len(ODD) - 1  # one id repeats
    held = [k for k in marks if crc(k) % 5 == 0]
    assert sum(got[k]["predicted"] == marks[k][column] for k in held) >= 0.95 * len(held)
    for k, r in got.items():
        assert r["held_out"] == (crc(k) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)
    assert got[50_002]["score"] == got[50_003]["score"]


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality.quality])
def test_classifiers_without_labels_or_rows(spark, operator):
    docs, labels, _ = labelled(spark, 20)
    assert {r["score"] for r in operator(docs, labels.filter("false")).collect()} == {0.0}
    assert operator(docs.filter("false"), labels).count() == 0


def test_toxicity_is_sparse_and_ignores_held_out_labels(spark):
    docs, labels, _ = labelled(spark)
    w = toxicity.fit(docs, labels)
    assert 0 < len(w.places) < 3000
    flipped = labels.selectExpr("doc_id", "quality", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    v = toxicity.fit(docs, flipped)
    assert (w.places == v.places).all() and (w.values == v.values).all()


def test_language_id(spark):
    r = random.Random(4)
    parts = {"xa": ["ka", "lu", "mi", "to"], "xb": ["tsch", "ung", "öd", "ver"], "xc": ["ción", "dad", "ñe", "que"]}
    rows, langs = [], {}
    for k in range(450):
        lang = list(parts)[k % 3]
        rows.append((k, " ".join("".join(r.choices(parts[lang], k=3)) for _ in range(r.randrange(3, 60)))))
        langs[k] = lang
    docs = spark.createDataFrame([(i, t, langs[i], "s", 1) for i, t in rows] + [(50_000 + i, t, None, None, 1) for i, t in ODD], "doc_id bigint, text string, lang string, source string, rejected int")
    got = {x["doc_id"]: x for x in langid.languages(docs).collect()}
    held = [k for k in langs if crc(k) % 3 == 1]
    assert sum(got[k]["lang_pred"] == langs[k] for k in held) >= 0.98 * len(held)
    for i, t in ODD[:11]:
        x = got[50_000 + i]
        if not t or not re.search(r"[^\W\d_]", t):
            assert (x["lang_pred"], x["score"], x["rejected"]) == ("und", 0.0, True)
        else:
            assert x["lang_pred"] in parts and 0 <= x["score"] <= 1
        assert x["held_out"] == (crc(50_000 + i) % 3 == 1)
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(x["doc_id"] for x in langid.languages(docs).collect() if not x["rejected"])
    none = langid.languages(docs.filter("doc_id < 0"))
    assert none.count() == 0
    unlabelled = langid.languages(docs.withColumn("lang", docs["source"].substr(9, 1)).selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {x["lang_pred"] for x in unlabelled.collect()} == {"und"}


def random_texts(n=400):
    r = random.Random(3)
    return ["".join(r.choice("aabcdeeesst  ..,-01\"'<>=é日\n") for _ in range(r.randint(1, 60))) for _ in range(n)]


def test_token_store(spark):
    from tokenizers import Tokenizer

    rows = ODD[:12] + [(100 + k, t) for k, t in enumerate(random_texts())]
    rows += [(900 + k, t) for k, t in enumerate(["<|endoftext|>", "a<|endoftext|>b", "one two <|endoftext|> <|endoftext|>three", "<|endoftext", "|>x<|endo", "ftext|>"])]
    lib = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    at, want = 0, []
    for i, t in sorted(rows, key=lambda x: x[0]):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        at += len(ids)
    got = token_store.token_digests(table(spark, rows).repartition(5), tokenizer_path("byte_bpe_50k.json"))
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want
    assert token_store.token_digests(table(spark, []), tokenizer_path("byte_bpe_50k.json")).count() == 0
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
    try:
        split = token_store.token_digests(table(spark, rows), tokenizer_path("byte_bpe_50k.json"))
        assert sorted(map(tuple, split.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_tokenizer_files_of_other_kinds_get_whole_texts(spark):
    import json

    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        assert not token_store.cuts_allowed(json.load(f))
    lib = Tokenizer.from_file(path)
    rows = [(k, t) for k, t in enumerate(["Hello, World! it's", "", None, "a <|endoftext|> b", "word " * 50])]
    want = [(i, len(lib.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows]
    got = token_store.token_digests(table(spark, rows), path)
    assert sorted(map(tuple, got.select("doc_id", "n_tokens").collect())) == want


def test_token_files_have_page_indexes_and_encodings(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "t")
    token_store.write_tokens(table(spark, [(k, t) for k, t in enumerate(random_texts(200))]), tokenizer_path("byte_bpe_50k.json"), "file://" + path)
    f = sorted((tmp_path / "t").glob("*.parquet"))[0]
    column = pq.ParquetFile(f).metadata.row_group(0).column(2)
    assert column.has_offset_index and column.compression == "ZSTD"
    assert {"RLE_DICTIONARY", "PLAIN_DICTIONARY", "DELTA_BINARY_PACKED"} & set(column.encodings)


def test_sentencepiece(spark):
    from sentencepiece import SentencePieceProcessor

    lib = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    rows = ODD + [(100 + k, t) for k, t in enumerate(random_texts())]
    want = []
    for i, t in rows:
        ids = lib.encode(t or "")
        plain = (t or "").replace("▁", " ")
        want.append((i, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)), hashlib.sha256(plain.encode()).hexdigest(), plain == (t or ""), tuple(ids)))
    got = sentencepiece_fst.coded(table(spark, rows), tokenizer_path("piece_bpe_32k.model"), with_tokens=True).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"], r["decoded_sha256"], r["exact"], tuple(r["tokens"])) for r in got) == sorted(want)


def test_unigram_path_is_the_cheapest():
    pieces = {"▁": 2.0, "a": 1.5, "b": 1.5, "ab": 2.0, "▁a": 2.5, "ba": 1.0, "▁ab": 6.0}
    t = sentencepiece_fst.Transducer(False, True, False, True, {p: k for k, p in enumerate(pieces)}, pieces, {}, [], 99, [], True, False, 20.0)

    def best(s):
        if not s:
            return 0.0, []
        options = [(best(s[:-n])[0] + pieces[s[-n:]], [*best(s[:-n])[1], s[-n:]]) for n in range(1, 4) if len(s) >= n and s[-n:] in pieces]
        return min(options) if options else (best(s[:-1])[0] + 20.0, [*best(s[:-1])[1], s[-1]])

    r = random.Random(1)
    for _ in range(200):
        s = "▁" + "".join(r.choice("abab▁z") for _ in range(r.randrange(0, 9)))
        cost = sum(pieces.get(p, 20.0) for p in t.shortest(s))
        assert cost == pytest.approx(best(s)[0])


def message(*fields):
    """Bytes of a protocol buffer message: (number, value) with int, float, str or bytes values."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += varint(number << 3) + varint(value)
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        else:
            raw = value.encode() if isinstance(value, str) else value
            out += varint(number << 3 | 2) + varint(len(raw)) + raw
    return out


def double_array(rules):
    """A character map in the model file's form: child c of node p with offset o is at p ^ o ^ c."""
    texts, values = b"", {}
    for key, to in rules.items():
        values[key.encode()] = len(texts)
        texts += to.encode() + b"\0"
    units, used, bases, todo = [0] * 4096, {0}, set(), [(0, b"")]
    while todo:
        at, prefix = todo.pop()
        children = sorted({k[len(prefix)] for k in values if k.startswith(prefix) and len(k) > len(prefix)})
        slots = children + [0] * (prefix in values)
        offset = next(o for o in range(1, 2000) if at ^ o not in bases and not any((at ^ o ^ c) in used for c in slots))
        bases.add(at ^ offset)
        units[at] |= offset << 10 | (256 if prefix in values else 0)
        used |= {at ^ offset ^ c for c in slots}
        if prefix in values:
            units[at ^ offset] = 1 << 31 | values[prefix]
        for c in children:
            units[at ^ offset ^ c] = c
            todo.append((at ^ offset ^ c, prefix + bytes([c])))
    raw = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(raw)) + raw + texts


RULES = {"ﬁ": "fi", "Ａ": "A", "e\u0301": "é", "a": "a", "ab!": "B", "\t": " ", "\u00a0": " ", "…": "...", "x": ""}


@pytest.mark.parametrize("with_bytes", [True, False])
@pytest.mark.parametrize("flags", [(1, 1), (0, 0), (1, 0)])
def test_unigram_models_with_a_character_map_as_the_library(tmp_path, with_bytes, flags):
    from sentencepiece import SentencePieceProcessor

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] * with_bytes
    r = random.Random(7)
    chars = ["▁", *"abefiBAé.!lt"]
    pieces += [(c, -round(r.uniform(3, 6), 3), 1) for c in chars]
    words = {"".join(r.choices("abefiBAé.!lt", k=r.randrange(2, 5))) for _ in range(120)}
    pieces += [(w, -round(r.uniform(2, 9), 3), 1) for w in sorted(words)] + [("▁" + w, -round(r.uniform(2, 9), 3), 1) for w in sorted(words)[::2]]
    spec = message((2, double_array(RULES)), (3, flags[0]), (4, flags[1]), (5, 1))
    raw = b"".join(message((1, message((1, p), (2, s), (3, t)))) for p, s, t in pieces)
    raw += message((2, message((3, 1), *([(35, 1)] * with_bytes)))) + message((3, spec))
    path = tmp_path / "m.model"
    path.write_bytes(raw)
    t = sentencepiece_fst.compile_model(str(path))
    assert t.rules == RULES
    lib = SentencePieceProcessor(model_file=str(path))
    texts = ["", " ", "  a  b ", "ﬁle Ａb e\u0301…", "ab!a ab", "\ta\u00a0b", "日本a😀😀", "x", "xx a x"]
    texts += ["".join(r.choice(["a", "b", "e", "f", "i", "B", "ﬁ", "Ａ", "é", ".", "!", "l", "t", " ", " ", "x", "ab!", "日"]) for _ in range(r.randrange(1, 40))) for _ in range(300)]
    ids, offsets = sentencepiece_fst.encode_rows(pa.array(texts), t)
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == lib.encode(text), text


def test_media(spark):
    rows = [*ODD[:11], (20, "nul\x00"), (21, "nul"), (22, "x" * 64)]
    stored = media.store_payloads(table(spark, rows).repartition(3))
    for r in stored.collect():
        store, path = fs.FileSystem.from_uri(r["shard"])
        with store.open_input_file(path) as f:
            raw = f.read()
        assert f"{r['payload_sha256']}.png" in media.tar_names(raw)
        with tarfile.open(fileobj=io.BytesIO(raw)) as t:
            assert t.extractfile(f"{r['payload_sha256']}.png").read() == raw[r["offset"] : r["offset"] + r["length"]]
    got = {r["doc_id"]: r for r in media.media_table(table(spark, rows)).collect()}
    pngs = {}
    for r in stored.collect():
        store, path = fs.FileSystem.from_uri(r["shard"])
        with store.open_input_file(path) as f:
            pngs[r["doc_id"]] = f.read_at(r["length"], r["offset"])
    for i, t in rows:
        body = (t or "").encode()
        payload = body + bytes(max(64, -(-len(body) // 64) * 64) - len(body))
        width, height, pixels = decoded_png(pngs[i])
        assert (width, height, pixels) == (64, len(payload) // 64, payload)
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(body), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r["media_bytes"], r["media_sha256"], r["feature"]) == (len(pngs[i]), hashlib.sha256(pngs[i]).hexdigest(), feature_of(payload))
        assert (r["width"], r["height"]) == (width, height)
    assert media.media_table(table(spark, [])).count() == 0


def decoded_png(raw):
    """Width, height and samples of an 8-bit grey PNG, with any of the five row filters."""
    assert raw[:8] == bytes([137, 80, 78, 71, 13, 10, 26, 10])
    at, packed, size = 8, b"", None
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 4], "big")
        kind, body = raw[at + 4 : at + 8], raw[at + 8 : at + 8 + n]
        assert int.from_bytes(raw[at + 8 + n : at + 12 + n], "big") == zlib.crc32(kind + body)
        if kind == b"IHDR":
            size = int.from_bytes(body[:4], "big"), int.from_bytes(body[4:8], "big")
            assert tuple(body[8:]) == (8, 0, 0, 0, 0)
        packed += body if kind == b"IDAT" else b""
        at += 12 + n
    width, height = size
    data, out, before = zlib.decompress(packed), b"", bytes(width)
    assert len(data) == height * (width + 1)
    for y in range(height):
        how, line = data[y * (width + 1)], bytearray(data[y * (width + 1) + 1 : (y + 1) * (width + 1)])
        for x in range(width):
            left, up, corner = (line[x - 1] if x else 0), before[x], (before[x - 1] if x else 0)
            paeth = min((left, up, corner), key=lambda c: abs(left + up - corner - c))
            line[x] = (line[x] + (0, left, up, (left + up) // 2, paeth)[how]) % 256
        before = bytes(line)
        out += before
    return width, height, out


def feature_of(payload):
    n = len(payload)
    mean = sum(payload) / n
    dev = (sum((x - mean) ** 2 for x in payload) / n) ** 0.5
    edges = sum(abs(a - b) > 32 for a, b in zip(payload[:-1], payload[1:], strict=True))
    return f"rows={n // 64};mean={mean:.3f};dev={dev:.3f};edges={edges};levels={','.join(str(sum(x // 32 == k for x in payload)) for k in range(8))}"


def test_copies_of_one_text_need_no_room(spark):
    """A task's rows go on as they come, however many share one payload."""
    many = spark.range(200_000).selectExpr("id as doc_id", "'the same text' as text").coalesce(1)
    stored = media.store_payloads(many)
    assert stored.select("shard", "offset", "length").distinct().count() == 1 and stored.count() == 200_000


def test_nothing_to_encode(spark):
    assert sentencepiece_fst.coded(table(spark, []), tokenizer_path("piece_bpe_32k.model"), with_tokens=True).count() == 0


@given(st.text())
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape_line(chat.escape_line(text)) == text
    assert "<|" not in chat.escape(text) and "\n" not in chat.escape_line(text)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", "<|im_end|>", ""]), st.text(alphabet="<|>ima_end\\\n x", max_size=30)), max_size=6))
def test_formatted_turns_read_back(turns):
    out = "".join(t for t, _ in chat.compile_template(chat.TEMPLATE)({"role": r, "text": x} for r, x in turns))
    assert list(chat.read_turns(out)) == turns


def render(source, **env):
    return "".join(t for t, _ in chat._pieces(chat.fold(chat.parse(source)), False)(env))


def test_template_language():
    assert render("{% for m in xs %}{{ loop.index0 }}{% if loop.first %}!{% elif m == 'b' %}B{% else %}{{ m | upper }}{% endif %}{# no #}{% endfor %}", xs=["a", "b", "c"]) == "0!1B2C"
    assert render("{{ a.b['c'] ~ 1 }}", a={"b": {"c": "x"}}) == "x1"
    assert render("{{ missing.item }}{{ none }}|{{ not true or 1 == 1 }}") == "|True"
    assert chat.fold(chat.parse("a{{ 'b' ~ 'c' }}{% if 1 == 2 %}x{% else %}d{% endif %}")) == (chat.Out(chat.Const("abcd")),)
    for bad in ("{{ a.__class__() }}", "{{ ''|nofilter }}", "{% for x in y %}", "{% import os %}", "{{ }}", "{{ (1 }}", "{{ a b }}"):
        with pytest.raises(chat.TemplateError):
            chat.parse(bad)
    assert render("{{ a.__class__ }}", a="text") == ""


def test_chat_table(spark):
    rows = [(1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "a\\b <| c"), (2, 1, "assistant", None), (2, 0, None, "x"), (None, 0, "user", "n"), (3, 5, "assistant", "é😀"), (3, 5, "assistant", "é😀"), (3, None, "system", "")]
    table = spark.createDataFrame([(*r, 7) for r in rows], "conv_id bigint, turn bigint, role string, text string, seq int")
    want = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        body = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        want[conv] = (len(turns), hashlib.sha256(body.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    long = spark.createDataFrame([(8, k, role, "word <| " * 200_000, 7) for k, role in enumerate(("user", "assistant"))], table.schema)
    said = "word <| " * 200_000
    one = chat.chat_table(long).first()
    assert (one["n_turns"], one["loss_chars"], one["loss_sha256"]) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
    for chars in (1, chat.ROW_CHARS):
        got = chat.chat_digests(chat.formatted(table, row_chars=chars)).collect()
        assert {r["conv_id"]: tuple(r)[1:5] for r in got} == want
    assert chat.chat_table(table.filter("false")).count() == 0


def test_a_worker_keeps_its_transducer_until_another_operator_runs():
    batch = pa.record_batch({"doc_id": pa.array([1, 2]), "text": pa.array(["a word", None])})
    t = sentencepiece_fst.compile_model(tokenizer_path("piece_bpe_32k.model"))
    run = sentencepiece_fst._coded(t, "key", False)
    first = [b.to_pylist() for b in run(iter([batch]))]
    kept = sentencepiece_fst.tv._kept["key"]
    assert [b.to_pylist() for b in run(iter([batch]))] == first
    assert sentencepiece_fst.tv._kept["key"] is kept and kept[0] is not t
    assert list(sentencepiece_fst.tv.held(iter([batch]), "text")) == [batch]
    assert not sentencepiece_fst.tv._kept
