import random
import re

import pytest

from hybridflow.llm.pii import find, luhn, personal_data, plain_spans

# The contract's patterns.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            fine = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda d=digits: 13 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]()
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("alphabet", ["a1@.+-_ (2504b@.", "0123456789 -", "+1 ().-23", "12.34 .5"])
def test_plain_spans_as_the_patterns_say(alphabet):
    rng = random.Random(7)
    for _ in range(8000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
        assert plain_spans(text) == brute(text)


@pytest.mark.parametrize(
    ("text", "kind", "source"),
    [
        ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com"),
        ("john.smith at example dot co dot uk", "email", "john.smith at example dot co dot uk"),
        ("john(at)example.com", "email", "john(at)example.com"),
        ("write to jоhn@exаmple.com!", "email", "jоhn@exаmple.com"),
        ("ｊｏｈｎ＠example．com", "email", "ｊｏｈｎ＠example．com"),
        ("x jo​hn@example.com", "email", "jo​hn@example.com"),
        ("pedro arroba correo punto es", "email", "pedro arroba correo punto es"),
        ("j.doe@mail dot example dot org", "email", "j.doe@mail dot example dot org"),
        ("call plus one four one five five five five two six seven one", "phone", "plus one four one five five five five two six seven one"),
        ("card four one one one one one one one one one one one one one one one", "card", "four" + " one" * 15),
        ("card ４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
        ("host one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
        ("192[.]168[.]1[.]1", "ip", "192[.]168[.]1[.]1"),
    ],
)
def test_disguises_map_back_to_source_places(text, kind, source):
    plain, every = find(text)
    assert (kind, text.index(source), text.index(source) + len(source)) in every
    assert set(plain) <= set(every)


@pytest.mark.parametrize(
    ("text", "kind", "source"),
    [
        ("host one dot two dot three dot four", "ip", "one dot two dot three dot four"),
        ("host 10 point 0 point 0 point 1 ici", "ip", "10 point 0 point 0 point 1"),
        ("host 1 Punkt 2 Punkt 3 Punkt 4 hier", "ip", "1 Punkt 2 Punkt 3 Punkt 4"),
        ("host 1 punto 2 punto 3 punto 4", "ip", "1 punto 2 punto 3 punto 4"),
        ("host 10 dot one.20 . two", "ip", "10 dot one.20 . two"),
        ("call plus 1 five 5 five 5 two 5 seven 1 four", "phone", "plus 1 five 5 five 5 two 5 seven 1 four"),
        ("card four 111 1111 one 111 1111", "card", "four 111 1111 one 111 1111"),
        (f"j@{'a' * 70} dot {'b' * 70} dot org", "email", f"j@{'a' * 70} dot {'b' * 70} dot org"),
        ("a@b.co, or john at mail dot example dot org", "email", "john at mail dot example dot org"),
    ],
)
def test_disguises_without_two_spelled_digits_side_by_side(text, kind, source):
    assert (kind, text.index(source), text.index(source) + len(source)) in find(text)[1]


@pytest.mark.parametrize("text", ["one " + "1" * 300_000, "one two " + "1" * 300_000, "one 1" + " " * 300_000, "a@b " + "a dot " * 50_000, "one . " * 50_000, "a one 1 " * 40_000])
def test_long_runs_beside_a_spelled_digit_take_linear_time(text):
    import time

    started = time.perf_counter()
    find(text)
    assert time.perf_counter() - started < 20


@pytest.mark.parametrize(
    "text", ["we met at the dot com boom", "look at example.com", "he was at one point four", "one two three four five", "a (at) b", "Москва и люди"]
)
def test_common_prose_stays_clean(text):
    assert find(text) == ([], [])


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000, "1." * 150_000, " " * 300_000, "a dot " * 50_000, "+1 " * 100_000, "one " * 60_000, "[" * 200_000])
def test_long_runs_take_linear_time(text):
    import time

    started = time.perf_counter()
    find(text)
    assert time.perf_counter() - started < 20


def test_odd_rows_and_empty_table(docs_of, odd_rows):
    rows = personal_data(docs_of([*odd_rows, (50, "é😀 a@b.co +1 (212) 555-0100")])).collect()
    assert len(rows) == len(odd_rows) + 1
    assert [tuple(s) for r in rows if r["doc_id"] == 50 for s in r["spans"]] == [("email", 3, 9), ("phone", 10, 27)]
    assert all(r["base"] == [] and r["spans"] == [] for r in rows if r["doc_id"] in (1, 2, 3, 4))
    assert personal_data(docs_of([])).count() == 0
