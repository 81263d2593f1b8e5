import datetime

import pytest

from tintwell.llm import pii, queries

CARD = "4111 1111 1111 1111"
SPANISH, BELGIAN, GERMAN = "ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00"


@pytest.mark.parametrize(
    ("before", "value", "after", "kind"),
    [
        ("", CARD, " 123", "card"),
        ("", CARD, " 12/27", "card"),
        ("12 ", CARD, "", "card"),
        ("12 ", CARD, " 123", "card"),
        ("", "4111-1111-1111-1111", " 99", "card"),
        ("", SPANISH, " EUR", "iban"),
        ("", SPANISH, " FROM 2024", "iban"),
        ("", BELGIAN, " EUR", "iban"),
        ("", GERMAN, " EUR", "iban"),
        ("AB12 ", GERMAN, "", "iban"),
        ("", "2024-01-02", "T10:00:00", "date"),
        ("at ", "2024-01-02", "T1000Z", "date"),
        ("12-", "4111-1111-1111-1111", "", "card"),
        ("", "555 123 4567", " 20242", "phone"),
    ],
)
def test_a_value_beside_others_is_found(before, value, after, kind):
    by = pii.Pseudonymiser(b"secret")
    new, spans = by.text(f"{before}{value}{after}")
    assert [s[0] for s in spans] == [kind] and value not in new
    _, start, end = spans[0]
    assert (new[:start], by.value(kind, new[start:end], back=True), new[end:]) == (before, value, after)


@pytest.mark.parametrize("text", ["4111 1111 1111 1112", "4111 1111 1111 1112 123", "DE00 3704 0044 0532 0130 00 EUR", "2024-01-02Tuesday", "1" * 500, "1 " * 500])
def test_what_has_no_valid_reading_stays(text):
    assert pii.Pseudonymiser(b"secret").text(text) == (text, [])


def test_a_number_before_a_card_is_read_too():
    by = pii.Pseudonymiser(b"secret")
    new, spans = by.text(f"(555) 123-4567 {CARD}; 10.0.0.1 {CARD} 123 {SPANISH} EUR 2024-01-02T10:00")
    assert [s[0] for s in spans] == ["phone", "card", "ip", "card", "iban", "date"]
    assert [by.value(k, new[a:b], back=True) for k, a, b in spans] == ["(555) 123-4567", CARD, "10.0.0.1", CARD, SPANISH, "2024-01-02"]


def test_spellings_of_a_value_are_linked():
    by = pii.Pseudonymiser(b"k")
    days = {form: by.value("date", day.strftime(form)) for day in [datetime.date(2020, 3, 14)] for form in ("%Y-%m-%d", "%d.%m.%Y", "%d/%m/%Y", "%m/%d/%Y")}
    assert len({datetime.datetime.strptime(v, form) for form, v in days.items()}) == 1
    for form, v in days.items():
        assert by.value("date", v, back=True) == datetime.date(2020, 3, 14).strftime(form)
    early = [by.value("date", t) for t in ("2021-05-06", "06.05.2021", "05/06/2021")]
    assert len({datetime.datetime.strptime(v, f) for v, f in zip(early, ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y"), strict=True)}) == 1
    a, b = by.value("email", "John.doe@x.org"), by.value("email", "john.doe@x.org")
    assert a.lower() == b and a[0].isupper() and by.value("email", a, back=True) == "John.doe@x.org"
    digits = lambda t: "".join(filter(str.isdigit, t))
    assert digits(by.value("phone", "+1 555 123 4567")) == digits(by.value("phone", "+15551234567"))
    assert digits(by.value("phone", "(555) 123-4567")) == digits(by.value("phone", "555.123.4567"))
    for v in ("+1 555 123 4567", "(055) 123-4567"):
        assert by.value("phone", by.value("phone", v), back=True) == v


def test_the_query_can_be_read_back(spark, sf_dir):
    """Every text of the query is the source's but for its values, and those decode to what the source has there."""
    got = {r.doc_id: r for r in queries.op4_pii(spark, sf_dir).collect()}
    by, total = pii.Pseudonymiser(queries.pii_key(spark)), 0
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        text, spans = by.text(r.text)
        assert (got[r.doc_id].text, got[r.doc_id].n_values, got[r.doc_id].kinds) == (text, len(spans), [k for k, _, _ in spans])
        total += len(spans)
        back, at = [], 0
        for kind, start, end in spans:
            value = by.value(kind, text[start:end], back=True)
            assert value is not None and value != text[start:end]
            back += [text[at:start], value]
            at = end
        assert "".join(back) + text[at:] == r.text
    assert total > 0
