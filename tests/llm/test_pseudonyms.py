"""Pseudonyms: round trips, formats, links, and a Feistel in plain Python."""

import hashlib
import re

from pyspark.sql import functions as F

from fleetbook.llm import pseudonyms as ps

KEY = "test key"


def feistel(values, radices, tweak):
    state, half = list(values), len(values) // 2
    for r in range(ps.ROUNDS):
        left = r % 2 == 0
        seen = ".".join(str(x) for j, x in enumerate(state) if (j < half) != left)
        new = list(state)
        for i, x in enumerate(state):
            if (i < half) == left:
                mark = hashlib.sha256("|".join([KEY, tweak, str(r), str(i), seen]).encode()).hexdigest()
                new[i] = (x + int(mark[:12], 16)) % radices[i]
        state = new
    return state


def luhn(s):
    ds = [int(c) for c in reversed(s)]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(ds)) % 10


def run(spark, rows, forward=True):
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, found string, n_ip int")
    return ps.pseudonymise(df, KEY, forward=forward).collect()


TEXT = ("Mail Ann.34@mail7.example.com or +1 (456) 555-2186 4417744280351547 99, ip 97.51.17.173. "
        "Born 1990-02-28, 31/12/1999 and 1.2.2003; card 4111 1111 1111 1111; amex 3782 822463 10005; +442079460958.")


def test_feistel_matches_plain_python(spark):
    values, radices = [3, 9, 0, 25, 250, 7, 1], [10, 10, 10, 26, 256, 8, 2]
    row = spark.createDataFrame([(list(zip(values, radices)),)], "v array<struct<x:long,m:long>>")
    moved = ps.feistel(F.col("v"), F.lit("t"), KEY)
    back = ps.feistel(moved, F.lit("t"), KEY, forward=False)
    got, undone = row.select(moved.alias("a"), back.alias("b")).first()
    assert [e.x for e in got] == feistel(values, radices, "t")
    assert [e.x for e in undone] == values


def test_formats_and_round_trip(spark):
    row = run(spark, [(1, TEXT)])[0]
    assert (row.n_values, row.n_email, row.n_phone, row.n_card, row.n_ip, row.n_date) == (10, 1, 2, 3, 1, 3)
    shape = re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "9", row.text)))
    assert len(shape) >= len(TEXT) - 6
    mail, phone, card, ip, iso, slash, dot, spaced, amex, plain = row.pseudonyms
    assert re.fullmatch(r"[A-Z][a-z]{2}\.\d\d@mail7\.example\.com", mail) and not mail.startswith("Ann.34")
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", phone) and phone != "+1 (456) 555-2186"
    for new, old in ((card, "4417744280351547"), (spaced, "4111 1111 1111 1111"), (amex, "3782 822463 10005")):
        assert re.sub(r"\d", "9", new) == re.sub(r"\d", "9", old) and new != old
        assert luhn(re.sub(r"\D", "", new)) == 0
    assert all(0 <= int(x) <= 255 for x in ip.split("."))
    assert re.fullmatch(r"\d{4}-\d\d-\d\d", iso) and re.fullmatch(r"\d\d/\d\d/\d{4}", slash)
    assert re.fullmatch(r"\d{1,2}\.\d{1,2}\.\d{4}", dot) and re.fullmatch(r"\+\d{12}", plain)
    assert "4417744280351547" not in row.text and " 99, ip " in row.text
    back = run(spark, [(1, row.text)], forward=False)[0].text
    assert re.sub(r"\b0", "", back) == re.sub(r"\b0", "", TEXT)


def test_invalid_values_stay(spark):
    text = "9807915762804491 1234567890123456 300.1.1.1 1.2.3 2023-02-30 99/99/2020 32.1.2020 v4.0. 12345 a@b @x 1.2.3.4.5"
    row = run(spark, [(1, text)])[0]
    assert row.text == text and row.n_values == 0 and row.pseudonyms == []


def test_equal_values_stay_linked_and_permutation(spark):
    rows = run(spark, [(i, f"x 10.0.{i % 100}.7 y 2020-01-{i % 28 + 1:02d} z") for i in range(200)])
    new = {}
    for r in rows:
        new.setdefault(r.doc_id % 100, set()).add(r.pseudonyms[0])
    assert all(len(v) == 1 for v in new.values()) and len(set.union(*new.values())) == 100
    dates = {(r.doc_id % 28, r.pseudonyms[1]) for r in rows}
    assert len(dates) == 28 and len({d for _, d in dates}) == 28


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "no data"), (None, "10.0.0.1"), (4, "10.0.0.1"), (4, "10.0.0.1"),
            (5, "10.0.0.1 " * 3000), (6, "digits 7 only")]
    got = {(r.doc_id, r.text, r.n_values) for r in run(spark, rows)}
    new = next(t for d, t, _ in got if d == 4)
    assert got == {(1, None, 0), (2, "", 0), (3, "no data", 0), (None, new, 1), (4, new, 1),
                   (5, f"{new} " * 3000, 3000), (6, "digits 7 only", 0)}
    assert len(run(spark, rows)) == 8 and run(spark, []) == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, TEXT)], "doc_id long, text string")
    assert "Python" not in ps.pseudonymise(df, KEY)._jdf.queryExecution().executedPlan().toString()


PHONES = ["+33 1 23 45 67 89", "+91 98765 43210", "+44 7911 123456", "+49 30 1234567", "+1 5551234567", "(555) 123-4567",
          "555-123-4567", "555.123.4567", "1-555-123-4567", "+44 (0)20 7946 0958", "+33 (1) 23 45 67 89", "+1.555.123.4567",
          "+(33) 1 23 45 67 89", "(020) 7946 0958", "+33 1.23.45.67.89", "+15551234567", "+1(555)123-4567"]


def test_phone_forms_and_year_first_dates(spark):
    rows = run(spark, [(i, f"call {p}, or not") for i, p in enumerate(PHONES)])
    for r, p in zip(rows, PHONES):
        assert (r.n_phone, r.n_values) == (1, 1) and r.pseudonyms[0] != p, p
        assert r.text == f"call {r.pseudonyms[0]}, or not"
        assert re.sub(r"\d", "9", r.pseudonyms[0]) == re.sub(r"\d", "9", p)
    assert [r.text for r in run(spark, [(r.doc_id, r.text) for r in rows], forward=False)] == [
        f"call {p}, or not" for p in PHONES]
    text = "2024/01/05 and 2024/13/05; +33 1 23 45 67 89 2024-01-05; +33 1 23 45 67 89 4111 1111 1111 1111; 2020-555-123-4567"
    row = run(spark, [(1, text)])[0]
    assert (row.n_date, row.n_phone, row.n_card, row.n_values) == (2, 2, 1, 5)
    assert " and 2024/13/05; " in row.text and row.text.endswith("; 2020-555-123-4567")
    assert re.fullmatch(r"\d{4}/\d\d/\d\d", row.pseudonyms[0]) and run(spark, [(1, row.text)], forward=False)[0].text == text


def test_one_number_in_any_grouping_has_one_pseudonym(spark):
    for forms in (["+44 7911 123456", "+447911123456", "+44 (79) 11-123456", "+4479 111 234 56"],
                  ["+1 555 123 4567", "+15551234567", "+1 (555) 123-4567"], ["+353 1 234 5678", "+35312345678"]):
        rows = run(spark, [(i, f"call {p} now") for i, p in enumerate(forms)])
        new = {re.sub(r"\D", "", r.pseudonyms[0]) for r in rows}
        assert len(new) == 1 and new != {re.sub(r"\D", "", forms[0])}, forms
        assert all(re.sub(r"\d", "9", r.pseudonyms[0]) == re.sub(r"\d", "9", p) for r, p in zip(rows, forms))
        assert [r.text for r in run(spark, [(r.doc_id, r.text) for r in rows], forward=False)] == [f"call {p} now" for p in forms]


def test_long_addresses_are_found(spark):
    mail = "a" * 300 + "@" + ".".join(["b" * 70] * 12) + ".museum"
    row = run(spark, [(1, f"to {mail} now")])[0]
    assert row.n_email == 1 and mail.split("@")[0] not in row.text and row.text.endswith(mail.split("@")[1] + " now")


IBANS = ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "FR14 2004 1010 0505 0001 3M02 606", "NO9386011117947",
         "ES91 2100 0418 4502 0005 1332", "MT84MALT011000012345MTLCAST001S"]


def iban_rest(text):
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def test_account_numbers(spark):
    rows = run(spark, [(i, f"to {x}, today") for i, x in enumerate(IBANS)])
    for r, x in zip(rows, IBANS):
        new, = r.pseudonyms
        assert r.n_iban == 1 and new != x and new[:2] == x[:2] and iban_rest(new) == 1, x
        assert re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", new)) == re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", x))
        assert r.text == f"to {new}, today"
    assert [r.text for r in run(spark, [(r.doc_id, r.text) for r in rows], forward=False)] == [f"to {x}, today" for x in IBANS]
    spaced = run(spark, [(1, "DE89 3704 0044 0532 0130 00")])[0].pseudonyms[0]
    assert spaced.replace(" ", "") == rows[0].pseudonyms[0]
    wrong = "DE88370400440532013000 GB29 NWBK 6016 1331 9268 18 AB12 and XX00123456789012"
    assert run(spark, [(1, wrong)])[0].text == wrong


def test_national_numbers_and_short_dates(spark):
    numbers = ["123-45-6789", "665-01-0001", "667-99-9999", "899-50-5000", "001-01-0001"]
    rows = run(spark, [(i, f"no. {x}.") for i, x in enumerate(numbers)])
    for r in rows:
        area, group, serial = map(int, r.pseudonyms[0].split("-"))
        assert r.n_national == 1 and 0 < area < 900 and area != 666 and 0 < group < 100 and 0 < serial < 10_000
        assert re.fullmatch(r"no\. \d{3}-\d\d-\d{4}\.", r.text)
    assert [r.text for r in run(spark, [(r.doc_id, r.text) for r in rows], forward=False)] == [f"no. {x}." for x in numbers]
    wrong = "666-12-3456 900-12-3456 000-12-3456 123-00-4567 123-45-0000 1123-45-6789 123-45-67890"
    assert run(spark, [(1, wrong)])[0].text == wrong
    row = run(spark, [(1, "on 2024-1-5, not 2024-13-5 or 2024-2-30")])[0]
    assert row.n_date == 1 and re.search(r"on \d{4}-\d{1,2}-\d{1,2}, not 2024-13-5 or 2024-2-30", row.text)
