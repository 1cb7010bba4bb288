"""Texts far from every language go, clean texts that the fit didn't see stay."""

import base64
import os
import random
import zlib

import pytest

from factlake.llm import langid

PARTS = {"xa": ["ka", "lu", "mi", "to"], "xb": ["tsch", "ung", "öd", "ver"], "xc": ["ción", "dad", "ñe", "que"]}
SF = "/root/testdata/sf0.001"


def gibberish(r):
    out = []
    for n in (200, 500, 2000, 5000):
        out += ["".join(chr(r.randint(0x4E00, 0x9FA5)) for _ in range(n)), "".join(r.choice([*map(chr, range(0x430, 0x450)), *" " * 5]) for _ in range(n)), "".join(r.choice([*map(chr, range(0x627, 0x64A)), *" " * 5]) for _ in range(n))]
        out += [base64.b64encode(r.randbytes(n)).decode(), "a" + r.randbytes(n).hex(), "".join(r.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n))]
    return out


FOREIGN = [
    "Съешь же ещё этих мягких французских булок, да выпей чаю. Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему.",
    "كل البشر يولدون أحرارا ومتساوين في الكرامة والحقوق وهم قد وهبوا العقل والوجدان وعليهم أن يعاملوا بعضهم بعضا بروح الإخاء",
    "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다.",
    "全ての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "#include <stdio.h>\nint main(void) { int k; for (k = 0; k < 10; k++) { printf(\"%d\\n\", k * k); } return 0; }\n" * 3,
    "for (var i=0;i<xs.length;i++){if(xs[i]!==null&&ys[i]>0x1f){zs.push(xs[i]^ys[i]);}}\n" * 5,
]


def checked(spark, docs, far):
    more = spark.createDataFrame([(10**7 + i, t, None) for i, t in enumerate(far)], "doc_id bigint, text string, lang string")
    docs = docs.select("doc_id", "text", "lang").unionByName(more)
    rows = langid.languages(docs).collect()
    kept = {r["doc_id"] for r in langid.accepted(docs).collect()}
    assert kept == {r["doc_id"] for r in rows if not r["rejected"]}
    assert [i for i in range(len(far)) if 10**7 + i in kept] == []
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 10**7]
    assert held
    return held


def test_gibberish_goes_and_unseen_clean_texts_stay(spark):
    r = random.Random(4)
    rows = [(k, " ".join("".join(r.choices(PARTS[lang], k=3)) for _ in range(r.randrange(3, 60))), lang) for k in range(450) for lang in [list(PARTS)[k % 3]]]
    held = checked(spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), gibberish(r) + FOREIGN)
    assert len(held) == sum(zlib.crc32(str(k).encode()) % 3 == 1 for k, _, _ in rows)
    assert not any(x["rejected"] for x in held)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
def test_same_on_the_drivers_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    blank = {x["doc_id"] for x in docs.filter(r"text is null or not text rlike '\\p{L}'").collect()}
    assert not any(x["rejected"] for x in checked(spark, docs, gibberish(random.Random(5)) + FOREIGN) if x["doc_id"] not in blank)
