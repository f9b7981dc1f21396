import re

import pytest
from pyspark.sql import functions as F

from triplake.llm import surrogates as sg

TEXTS = [
    "Mail bob.19@mail5.example.com or BOB.19@mail5.example.com; card 4785380592391139$$$ and 4785-3805-9239-1139",
    "call +1 (743) 555-3824 or 743-555-3824. ip 152.143.123.131### token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"",
    "Mr. John Smith met Frau Erika Mustermann and Dr. Smith; Mrs JANE DOE. Господин Иван Петров, ssn 123-45-6789",
    "éré.12@mail3.example.com ann.12@mail3.example.com ann.13@mail3.example.com 4785380592391139",
]
CLEAN = ["Luhn alone: 6992706490339255", "plain text, version 1.2.3 of 2020-01-02, 12:30", "not a card 2123465659789240", "300.1.1.1 is no address 1.2.3.4.5",
         "", "The token of love; password: extraordinarily. Apache License, Drum Set", "Mr smith", "a@b", "tel 555-3824"]


@pytest.fixture(scope="module")
def replaced(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS + CLEAN)] + [(None, None, "s"), (0, TEXTS[0], "s"), (77, "x " * 50000 + TEXTS[1], "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_entities string")
    return [(r.doc_id, r.text, r.n_entities) for r in sg.replace(docs).collect()]


def test_originals_go_and_clean_texts_stay(replaced):
    by = {i: t for i, t, _ in replaced}
    for i, t in enumerate(CLEAN, len(TEXTS)):
        assert by[i] == t
    secrets = ["bob.19", "4785380592391139", "4785-3805", "555-3824", "152.143", "24be6443", "John", "Smith", "Erika", "Иван", "123-45", "JANE"]
    assert not any(s in by[i] for s in secrets for i in range(len(TEXTS)))
    assert [n for i, _, n in replaced if i == 0] == [4, 4] and {n for i, _, n in replaced if i is None} == {0}
    assert [t for i, t, _ in replaced if i == 0][0] == [t for i, t, _ in replaced if i == 0][1]
    assert by[77].startswith("x x ") and by[77].endswith(by[1])


def test_formats_types_and_coreference(replaced):
    by = {i: t for i, t, _ in replaced}
    a, b = re.findall(r"\S+@\S+\.com", by[0])
    assert a.lower() == b.lower() and b.split("@")[0].isupper() and re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", a)
    x, y = re.search(r"card (\d{16})\$\$\$ and (\d{4}-\d{4}-\d{4}-\d{4})", by[0]).groups()
    assert x == y.replace("-", "") and x[0] == "4" and x in by[3]
    digits = [int(d) for d in x[::-1]]
    assert sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    p = re.search(r"call \+1 \((\d{3})\) (\d{3}-\d{4}) or (\d{3})-(\d{3}-\d{4})\.", by[1]).groups()
    assert p[:2] == p[2:]
    assert all(0 < int(o) < 256 for o in re.search(r"ip (\S+?)###", by[1])[1].split("."))
    assert re.search(r'token = "[0-9a-f]{40}"', by[1])
    m = re.match(r"Mr\. (\w+) (\w+) met Frau (\w+) (\w+) and Dr\. (\w+); Mrs ([A-Z]+) ([A-Z]+)\. Господин ([А-Я][а-я]+) ([А-Я][а-я]+), ssn \d{3}-\d\d-\d{4}$", by[2])
    assert m[2] == m[5] and m[1].endswith("o") and m[3].endswith("a") and m[6].endswith("A") and m[8].endswith("ов")
    hosts = {h for t in by.values() for h in re.findall(r"@(\S+\.com)", t or "")}
    assert len(hosts) == 2


def test_surrogates_are_distinct_and_no_unit(spark):
    # small spaces of surrogates: later attempts needed
    units = spark.range(20).select(F.lit("ssn").alias("kind"), F.format_string("%02d", "id").alias("norm")).unionByName(
        spark.createDataFrame([("local", c) for c in "abcdef"], "kind string, norm string"))
    rows = sg.attempts(units).collect()
    assert len({(r.kind, r.surrogate) for r in rows}) == 26
    assert not {(r.kind, r.surrogate) for r in rows} & {(r.kind, r.norm) for r in rows}
    assert max(r.attempt for r in rows) > 0


def test_texts_use_later_attempts(spark):
    texts = [f"user {c}@{h}.example.com" for c in "abcdefgh" for h in ("p", "q")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = [r.text for r in sg.replace(docs).orderBy("doc_id").collect()]
    local = {}
    for before, after in zip(texts, out):
        local.setdefault(before[5], set()).add(after[5])
    assert all(len(v) == 1 for v in local.values()) and len(set.union(*local.values())) == 8
    assert not set.union(*local.values()) & set(local)


def test_key_changes_surrogates_and_empty(spark):
    docs = spark.createDataFrame([(0, TEXTS[1])], "doc_id long, text string")
    assert sg.replace(docs, "one").first().text != sg.replace(docs, "two").first().text
    assert sg.replace(docs.limit(0)).count() == 0


def test_short_units_never_run_out_of_surrogates(spark):
    # every one-letter and one-digit local part, names without a letter or of another script, short hosts
    locals_ = [*"abcdefghijklmnopqrstuvwxyz0123456789", "_", "李", "王"]
    hosts = [c + ".org" for c in "abcdefghijklmnopqrstuvwxyz"] + ["1.org", "例.org"]
    units = spark.createDataFrame([("local", c) for c in locals_] + [("host", h) for h in hosts], "kind string, norm string")
    rows = sg.attempts(units).collect()
    assert len(rows) == len({(r.kind, r.surrogate) for r in rows}) == len(locals_) + len(hosts)
    assert not {(r.kind, r.surrogate) for r in rows} & {(r.kind, r.norm) for r in rows}
    assert all(r.surrogate.isdigit() for r in rows if r.norm.isdigit()) and not any("李" in r.surrogate for r in rows)


def test_texts_with_all_short_local_parts(spark):
    chars = "abcdefghijklmnopqrstuvwxyz0123456789"
    docs = spark.createDataFrame([(i, f"to {c}@mail.example.com") for i, c in enumerate(chars)], "doc_id long, text string")
    out = [re.fullmatch(r"to (\w+)@\w{4}\.\w{7}\.com", r.text)[1] for r in sg.replace(docs).collect()]
    assert len(set(out)) == 36 and not set(out) & set(chars)


def test_cards_next_to_other_numbers(spark):
    card = "4111 1111 1111 1111"
    texts = [f"{card} 12/27", f"{card} 123", f"2 {card}", f"4000 {card} {card}", f"7 {card.replace(' ', '')} 123",
             f"1 2 3 4 5 6 {card.replace(' ', '-')} 12th", "no 2 3782 822463 10005 1234", "2024 743-555-3824 100", "99 88 123-45-6789 123456"]
    clean = ["1990 1991 1992 1993 1994 1995 1996", "4111 1111 1111 1112 123", "1 " * 30000 + "1"]
    docs = spark.createDataFrame(list(enumerate(texts + clean)), "doc_id long, text string")
    rows = sg.replace(docs).orderBy("doc_id").collect()
    new = re.match(r"4\d{3} \d{4} \d{4} \d{4}", rows[0].text)[0]
    want = [t.replace(card, new).replace(card.replace(" ", ""), new.replace(" ", "")).replace(card.replace(" ", "-"), new.replace(" ", "-"))
            for t in texts]
    assert new != card and [r.text for r in rows[:6]] == want[:6]
    assert re.fullmatch(r"no 2 3\d{3} \d{6} \d{5} 1234", rows[6].text) and "822463" not in rows[6].text
    assert re.fullmatch(r"2024 \d{3}-\d{3}-\d{4} 100", rows[7].text) and "555-3824" not in rows[7].text
    assert re.fullmatch(r"99 88 \d{3}-\d\d-\d{4} 123456", rows[8].text) and "6789" not in rows[8].text
    assert [r.n_entities for r in rows] == [1, 1, 1, 2, 1, 1, 1, 1, 1, 0, 0, 0]
    assert [r.text for r in rows[9:]] == clean


def test_names_and_secrets_in_plain_forms(spark):
    texts = ["Mr J. Smith met Dr.\nAda Lovelace and Mr J.R.R. Tolkien", "Mr. John Smith left. Later John Smith, JOHN, Smith and Smithson spoke",
             "Dr. John Smith", "password: hunter2. password=S3cret!pass99, secret='ab,1' token: yes", "Mrs Ada Lovelace"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sg.replace(docs).orderBy("doc_id").collect()
    out = [r.text for r in rows]
    a = re.fullmatch(r"Mr ([A-Z])\. (\w+) met Dr\.\n(\w+) (\w+) and Mr ([A-Z])\.([A-Z])\.([A-Z])\. (\w+)", out[0])
    b = re.fullmatch(r"Mr\. (\w+) (\w+) left\. Later (\w+) (\w+), ([A-Z]+), (\w+) and Smithson spoke", out[1])
    c = re.fullmatch(r"Dr\. (\w+) (\w+)", out[2])
    d = re.fullmatch(r"password: ([a-z]{6}\d)\. password=([A-Z]\d[a-z]{4}![a-z]{4}\d\d), secret='ab,1' token: yes", out[3])
    e = re.fullmatch(r"Mrs (\w+) (\w+)", out[4])
    assert a and b and c and d and e
    assert a[1] != "J" and a[2] == b[2] == b[4] == b[6] == c[2] and b[5] == b[1].upper() and b[1] == b[3] == c[1] and b[1].endswith("o")
    assert (a[3], a[4]) == (e[1], e[2]) and e[1].endswith("a") and a[5] not in "JR" + a[6] and a[6] == a[7]
    assert not {"Smith", "John", "Ada", "Lovelace", "Tolkien"} & set(a.groups() + b.groups() + c.groups())
    assert d[1] != "hunter2" and "S3cret" not in d[2]
    assert [r.n_entities for r in rows] == [3, 5, 1, 2, 1]


def test_titles_in_a_row_particles_and_country_codes(spark):
    texts = ["Herr Dr. Hans Meier kam", "Mr Prof. Ada Byron left", "Mr Ludwig van Beethoven and Frau von der Leyen; Prof. Dr. Frau Eva de la Cruz",
             "call +41 44 123 45 now, +41 44 123 45 67, +1 (743) 555-3824 or 743-555-3824, +14155552671", "Herr Hans Meier"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = [r.text for r in sg.replace(docs).orderBy("doc_id").collect()]
    a = re.fullmatch(r"Herr Dr\. (\w+) (\w+) kam", out[0])
    b = re.fullmatch(r"Mr Prof\. (\w+) (\w+) left", out[1])
    c = re.fullmatch(r"Mr (\w+) van (\w+) and Frau von der (\w+); Prof\. Dr\. Frau (\w+) de la (\w+)", out[2])
    d = re.fullmatch(r"call \+41 (\d\d \d{3} \d\d) now, \+41 (\d\d \d{3} \d\d \d\d), \+1 \((\d{3})\) (\d{3}-\d{4}) or (\d{3})-(\d{3}-\d{4}), \+1(\d{10})", out[3])
    assert a and b and c and d
    assert out[4] == f"Herr {a[1]} {a[2]}" and a[1].endswith("o") and b[1].endswith("o") and c[4].endswith("a")
    assert d[1] != "44 123 45" and d[2] != "44 123 45 67" and d.group(3, 4) == d.group(5, 6) and d[7] != "4155552671"
    names = {w for t in texts[:3] for w in re.findall(r"[A-Z]\w{2,}", t)} - {"Herr", "Prof", "Frau"}
    assert not names & {w for m in (a, b, c) for w in m.groups()}


# what each part of ENTITY could be made to repeat
HOSTILE = ["x@" + "b." * 100000 + "com", "x@" + "b" * 100000, "x." * 100000 + "@b.com", "a@b." * 50000, "@" * 100000, "Mr " * 100000,
           "Mr A. " * 50000, "Mr " + "A." * 100000, "Mr " + "van " * 100000 + "B", "Herr\n" * 50000, "1." * 100000, "1.1.1.1." * 50000,
           "1 " * 100000, "4111 " * 50000, "+1 " * 100000, "+" * 100000, "(123) " * 50000, "123-" * 100000, "123-45-" * 50000,
           "token=" * 50000, "token = " + "x" * 100000, "password:" + " " * 100000, "'" * 100000, "É" * 100000, "\u00a0" * 100000]


def test_hostile_texts_of_many_repeats(spark):
    docs = spark.createDataFrame(list(enumerate(HOSTILE)), "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in sg.replace(docs).collect()}
    assert len(rows) == len(HOSTILE)
    for i in (0, 1, 4, 10, 12, 15, 22, 23, 24):
        assert rows[i].text == HOSTILE[i]


def test_marked_texts(spark):
    hashes = spark.range(3000).select(F.xxhash64("id").alias("t"))
    for n in (0, 1, 700, 3000):
        test = sg.marked_texts(hashes.limit(n))
        others = spark.range(5000, 25000).select(F.xxhash64("id").alias("t"))
        assert hashes.limit(n).where(test("t")).count() == n
        assert others.where(test("t")).count() <= 20000 / 8
