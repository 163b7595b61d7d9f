import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from typeferry.llm import pii
from typeferry.llm.queries import op13_pii

# The forms as they are defined, for any regular expression engine that tries left to right.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def passes(digits):
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(int(d) for d in digits[::-2])) % 10 == 0


def plain(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    for m in re.finditer(IP, text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(CARD, text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and passes(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(PHONE, text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def base(text):
    return [(pii.KINDS[k], a, b) for k, a, b, is_base in pii.scan(text) if is_base]


def added(text):
    return [(pii.KINDS[k], text[a:b]) for k, a, b, is_base in pii.scan(text) if not is_base]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_the_plain_forms(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()
    got = op13_pii(spark, f"/root/testdata/{sf}")
    assert got.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == len(rows)
    total = 0
    for row in rows:
        spans = plain(row.text)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = found[row.doc_id]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s[0] == kind for s in spans) for kind in pii.KINDS
        ]
        assert r.spans == text and r.n_added == 0  # these texts hold no disguises
        total += len(spans)
    assert total > 5


ALPHABET = "a.b@-+_% 0123456789()[]é, atdoplus\n０оО"


@settings(max_examples=1500, deadline=None)
@given(st.text(ALPHABET, max_size=60))
def test_base_spans_of_any_text(text):
    assert base(text) == plain(text)
    for kind, a, b, _ in pii.scan(text):
        assert 0 <= a < b <= len(text)


@settings(max_examples=500, deadline=None)
@given(st.text("0123456789 -.+", min_size=20, max_size=80))
def test_base_spans_of_numbers(text):
    assert base(text) == plain(text)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("write john [at] example [dot] com now", ("email", "john [at] example [dot] com")),
        ("jane dot doe (at) mail dot example (dot) org.", ("email", "jane dot doe (at) mail dot example (dot) org")),
        ("john.doe at example dot com please", ("email", "john.doe at example dot com")),
        ("USER AT MAIL DOT CO DOT UK", ("email", "USER AT MAIL DOT CO DOT UK")),
        ("user_at_example_dot_com", ("email", "user_at_example_dot_com")),
        ("ana arroba correo punto es", ("email", "ana arroba correo punto es")),
        ("bob(at)corp.de, or", ("email", "bob(at)corp.de")),
        ("john@example dot com", ("email", "john@example dot com")),
        ("john @ example . com", ("email", "john @ example . com")),
        ("of.34 at mail7.example.com geiever", ("email", "of.34 at mail7.example.com")),
        ("write jo AT mail.example.com", ("email", "jo AT mail.example.com")),
        ("ana arroba correo.es", ("email", "ana arroba correo.es")),
        ("jo at mail7 dot example.com", ("email", "jo at mail7 dot example.com")),
        ("joⓐmail.example.com", ("email", "joⓐmail.example.com")),
        ("5️⃣5️⃣00 0055 5555 5559", ("card", "5️⃣5️⃣00 0055 5555 5559")),
        ("+1 (zero one seven) five five five seven seven one three", ("phone", "+1 (zero one seven) five five five seven seven one three")),
        ("an x＠y．com", ("email", "x＠y．com")),
        ("see ivan@exаmple.com", ("email", "ivan@exаmple.com")),
        ("a​nn@exam­ple.com", ("email", "a​nn@exam­ple.com")),
        ("at 192[.]168[.]1[.]1", ("ip", "192[.]168[.]1[.]1")),
        ("one nine two dot one six eight dot zero dot one", ("ip", "one nine two dot one six eight dot zero dot one")),
        ("10 dot 0 dot 0 dot one", ("ip", "10 dot 0 dot 0 dot one")),
        ("1O.0.0.l2 there", ("ip", "1O.0.0.l2")),
        ("４１１１ １１１１ １１１１ １１１１", ("card", "４１１１ １１１１ １１１１ １１１１")),
        ("4111 l111 11I1 1111", ("card", "4111 l111 11I1 1111")),
        ("٤١١١١١١١١١١١١١١١", ("card", "٤١١١١١١١١١١١١١١١")),
        ("Four, one one one 1111 1111 one one one one!", ("card", "Four, one one one 1111 1111 one one one one")),
        ("vier eins eins eins 1111 1111 1111", ("card", "vier eins eins eins 1111 1111 1111")),
        ("plus four nine three zero one two three four five six", ("phone", "plus four nine three zero one two three four five six")),
        ("+1 five double five 0 one two three four", ("phone", "+1 five double five 0 one two three four")),
        ("＋1 (017) 555‑7713", ("phone", "＋1 (017) 555‑7713")),
    ],
)
def test_disguises(text, expected):
    assert expected in added(text)


@pytest.mark.parametrize(
    "text",
    [
        "meet me at example.com tomorrow", "MEET US AT EXAMPLE.COM", "in room 12 at example.com",
        "was here. at example.com", "at 10 at example.com", "she was at polka dot dress night", "look at this.com",
        "one or two or three", "un deux trois", "seis siete ocho nueve", "plus 20 points",
        "version 1.2.3 (at) least", "the dot is at the point", "5|6 and 7l and O2", "e-mail @ noon",
        "Он сказал: три, четыре", "3 point 5 point 6", "", "   ",
    ],
)
def test_clean_texts_stay(text):
    assert pii.scan(text) == []


def test_base_spans_stay_beside_longer_ones():
    text = "jоhn@example.com"  # the second letter is Cyrillic
    assert pii.scan(text) == [(0, 0, len(text), False), (0, 2, len(text), True)]
    assert pii.scan("4111111111111111 one two three") == [(2, 0, 16, True)]


def test_source_characters_of_edits():
    tape = pii.Tape("a​b​​cd")
    out = pii.unseen_gone(tape)
    assert out.text == "abcd" and [out.source(i, i + 1) for i in range(4)] == [
        (0, 1), (2, 3), (5, 6), (6, 7)
    ]
    again = out.edited([(1, 3, "XYZ")])
    assert again.text == "aXYZd" and again.source(2, 3) == (2, 6) and again.source(0, 5) == (0, 7)


def test_redacted(spark):
    rows = [("call +1 (017) 555-7713 or jo at ex dot com",), (None,), ("",), ("jоhn@example.com!",)]
    docs = spark.createDataFrame(rows, "text string")
    assert [r[0] for r in docs.select(pii.redacted(docs)).collect()] == [
        "call [phone] or [email]", None, "", "[email]!"
    ]


def test_odd_rows(spark):
    mail = "a@b.cd"
    rows = [(1, mail), (1, mail), (None, mail), (2, None), (3, ""), (4, "é" * 5 + mail)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit(1).alias("found"), F.lit(2).alias("spans"), F.lit(3).alias("n_email")
    )
    got = sorted((str(r.doc_id), r.n_email, r.spans) for r in pii.digest(docs).collect())
    one = "email:0:6"
    assert got == [("1", 1, one), ("1", 1, one), ("2", 0, ""), ("3", 0, ""), ("4", 1, "email:5:11"),
                   ("None", 1, one)]
    assert pii.digest(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "unit", ["a", "1", "1.", "1 ", "+1", "one ", "@a", "a@", "a.b@c.", " at ", "[dot]", "О", "l1",
             "one dot ", "1 dot ", "a at b dot "],
)
def test_long_runs_take_linear_time(unit):
    from time import perf_counter

    def seconds(n):
        start = perf_counter()
        pii.scan(unit * n)
        return perf_counter() - start

    seconds(1000)
    short, long = seconds(20_000), seconds(160_000)
    assert long < 8 * 4 * max(short, 0.01)
