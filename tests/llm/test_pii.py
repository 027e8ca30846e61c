from __future__ import annotations

import hashlib
import re

import numpy as np

from streakline.llm import pii
from tests.llm.conftest import odd_rows

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return [(k, a, b) for a, k, b in sorted(out)]


TRICKY = [
    "a@b.c, x.y+z@host.example.com. @@ q@@r.s t@u v@w.x@y.z a@b@c.d",
    "1.2.3.4.5.6.7.8 999.1.1.1 0255.010.3.4 1.2.3 1..2.3.4 12.34.56.78.",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111111111111111x 4-1-1",
    "+1 (403) 555-9312 +44 20 7946 0958. +1 2 +1234567890123456 ++1 403 555 93 12",
    "a" * 2000 + "@" + "b" * 2000 + ".c",
    "1" * 3000 + " " + "1." * 1500,
    "tel +1 (403) 555-9312, again 1 403 555 9312 or 555-9312; card 4111 1111 1111 1111, ref 4111.1111.1111.1111",
]


def test_patterns():
    for t in TRICKY + [t for _, t, *_ in odd_rows()]:
        assert pii.base_spans(t) == plain(t)


def test_long_words_take_linear_time():
    pii.base_spans("a" * 1_000_000 + " @ " + "1" * 1_000_000 + ".")


def test_query_columns(odd, documents):
    for docs in (odd, documents):
        rows = pii.find_personal_data(docs)
        texts = sorted((r["doc_id"], r["text"]) for r in docs.where("doc_id is not null and doc_id <> 5").select("doc_id", "text").distinct().collect())
        found = {r["doc_id"]: r for r in rows.collect()}
        assert rows.count() == docs.count()
        for i, t in texts:
            base, r = plain(t), found[i]
            written = pii.written(base)
            assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
            assert [r[c] for c in ("n_email", "n_ip", "n_card", "n_phone")] == [sum(k == x for k, _, _ in base) for x in range(4)]
            assert set(written.split(",")) - {""} <= set(r["spans"].split(","))


def test_field_adds_mentions_like_a_match(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(60):
        n = lambda k: "".join(rng.choice(list("0123456789"), k))
        rows.append((i, f"call +1 ({n(3)}) 555-{n(4)} or see order {n(8)} and mail user.{n(2)}@mail.example.com today"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    field = pii.train(docs)
    text = "call +1 (403) 555-9312 now; later dial 1 403 555 9312, order 20391847, mail user.14@mail.example.com, as user.14 said"
    base, every = field.spans(text)
    added = {text[a:b]: pii.KINDS[k] for k, a, b in every if (k, a, b) not in base}
    assert added == {"1 403 555 9312": "phone", "user.14": "email"}
    assert set(base) <= set(every)


def test_messages_agree_with_enumeration():
    field = pii.Field(np.random.default_rng(2).normal(size=(pii.WIDTH, 5)), np.zeros((5, 5)), np.array([1.5, 0.7]))
    field.chain = np.array([[0.3 * (i == j) for j in range(5)] for i in range(5)])
    text = "1234567 then 7654321 end"
    found = pii.candidates(text)
    own = np.array([pii.features(text, a, b, k) for a, b, _, k in found]) @ field.unary
    joint = np.exp(own[0][:, None] + own[1][None, :] + field.chain)
    joint /= joint.sum()
    chances = field.marginals(text, found)
    assert np.allclose(chances[0], joint.sum(axis=1), atol=1e-4) and np.allclose(chances[1], joint.sum(axis=0), atol=1e-4)


def test_repeated_tokens_cost_their_number(spark):
    text = "+1 (403) 555-9312, " + "1 403 555 9312; " * 3000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.find_personal_data(docs).first()["n_phone"] == 1
    assert len(pii.links(pii.candidates(text))) <= 3 * 3001


def test_a_match_reaches_all_its_repeats():
    field = pii.Field.empty()
    field.skip[:] = 8.0
    for lean in (0.0, 0.5):
        field.unary[0, pii.NONE] = lean
        for text in ("+1 (403) 555-9312, " + "1 403 555 9312; " * 3000, "1 403 555 9312; " * 3000 + "+1 (403) 555-9312", "+1 (403) 555-9312, " + "403 555 9312; " * 3000):
            base, every = field.spans(text)
            assert len(base) == 1 and len(every) == 3001 and {k for k, *_ in every} == {pii.PHONE}
            assert len(pii.links(pii.candidates(text))) <= 3 * 3001


def test_masks(odd, spark):
    docs = spark.createDataFrame([(1, "write a.b@c.de or 1.2.3.4", 25), (2, None, 3), (3, "", 0)], "doc_id long, text string, n_chars int")
    rows = {r["doc_id"]: r for r in pii.mask_personal_data(docs).collect()}
    assert rows[1]["text"] == "write [EMAIL] or [IP]" and rows[1]["n_chars"] == 21
    assert rows[2]["text"] is None and rows[3]["text"] == ""
    masked = pii.mask_personal_data(odd)
    assert masked.dtypes == odd.dtypes and masked.count() == odd.count()


def test_empty(none):
    assert pii.find_personal_data(none).collect() == []
    assert pii.mask_personal_data(none).collect() == []


def test_nothing_to_learn_from_adds_nothing(spark):
    docs = spark.createDataFrame([(i, f"order 5551234560 and again 5551234560 today {i}") for i in range(8)], "doc_id bigint, text string")
    assert all(r["spans"] == "" for r in pii.find_personal_data(docs).collect())
    assert {r["text"] for r in pii.mask_personal_data(docs).collect()} == {r["text"] for r in docs.collect()}


def test_names_and_all_similar_numbers_are_linked():
    found = pii.candidates("mail maria@x.org; later maria said maria")
    assert [f[3] for f in found] == ["maria@x.org", "maria", "maria"]
    found = pii.candidates("44201234567 then 9991234567 then 201234567")
    assert {(k, i, j) for k, i, j in pii.links(found) if k == 2} == {(2, 0, 2)}


def test_copies_do_not_fill_the_sample(spark):
    rows = [(i, "call +1 (403) 555-9312") for i in range(300)] + [(1000 + i, f"mail person{i}@host.example.com ref 123456{i:04d}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    field = pii.train(docs, size=40)
    # All e-mail texts but a few are in the sample, so mentions of e-mails are known.
    assert np.abs(field.unary[:, pii.EMAIL]).max() > 0.1


def test_sample_is_bounded_by_bytes(spark):
    rows = [(i, f"call {5550000000 + i} or +{15550000000 + i}") for i in range(50)] + [(99, "1" * 3000), (100, "no digits"), (101, None)]
    docs = spark.createDataFrame(rows + rows, "doc_id long, text string")
    every = {t for _, t in rows if t and any(c.isdigit() for c in t)}
    assert {r["text"] for r in pii.sampled_texts(docs).collect()} == every
    few = [r["text"] for r in pii.sampled_texts(docs, most_bytes=400).collect()]
    assert 0 < len(few) == len(set(few)) and 350 < sum(map(len, few)) <= 400
    assert pii.sampled_texts(docs, most_bytes=5) is None
    assert pii.sampled_texts(docs, size=4).count() == 4
