"""Surrogates: no name leaks, all mentions change alike, formats, full pools, and texts with many redrawn entities."""

import ipaddress

import pytest

from quire.llm import pii

SCHEMA = "doc_id long, text string, m string, _tag string, n_entities string"


def changed(spark, texts, key="k"):
    rows = [(i, t, "a", "b", "c") for i, t in enumerate(texts)]
    out = pii.pseudonymize(spark.createDataFrame(rows, SCHEMA), key).collect()
    assert {(r.m, r._tag) for r in out} == {("a", "b")}
    return [r.text for r in sorted(out, key=lambda r: r.doc_id)]


def test_every_mention_of_a_person_changes_alike(spark):
    first, second, third = changed(spark, ["Mr John Smith arrived. Smith left and John stayed; SMITH too.", "Mrs Smith wrote to Dr. Bell. Smith's letter.", "no Smith here"])
    given, family = first.split()[1:3]
    family = family.rstrip(".")
    assert first == f"Mr {given} {family} arrived. {family} left and {given} stayed; SMITH too."
    assert "John" not in first and "Smith" not in first + second and second.startswith(f"Mrs {family} ")
    assert third == "no Smith here"  # nothing tells that this is a name


@pytest.mark.parametrize("text, names", [("Mr. O'Neil spoke", ["O'Neil"]), ("Mr J. Smith and Sir A. B. Jones", ["Smith", "Jones"]), ("Herr élan", []), ("Frau Anna Müller-Lang", ["Anna", "Müller-Lang"]), ("господин Иванов", ["Иванов"])])
def test_names_behind_titles(text, names):
    assert [text[s:e] for s, e, *_ in pii.entities(text)] == names


def test_family_names_keep_their_gender(spark):
    text = changed(spark, ["госпожа Анна Иванова и господин Иванов"])[0].split()
    assert text[1][-1] == "а" and text[2].endswith("ова") and text[-1].endswith("ов") and "Иванов" not in " ".join(text)


def test_addresses_and_cards():
    found = [(kind, form) for _, _, kind, form in pii.entities("at 2001:db8::ff00:42:8329 or fe80::1, 3782 822463 10005 not 12:30:45 a::b::c")]
    assert ("ipv6", "2001:db8::ff00:42:8329") in found and ("ipv6", "fe80::1") in found and ("card", "378282246310005") in found
    assert len(found) == 3
    assert ipaddress.ip_address(pii.draw(b"k", "ipv6", "fe80::1", 0)).is_link_local
    long = "x" * 300 + "@mail.example.com"
    assert pii.entities(f"to {long}!")[0][:2] == (3, 3 + len(long))


def test_a_full_pool_takes_another_range():
    assert pii.draw(b"k", "ipv4", "192.168.1.2", 0).startswith("192.168.")
    assert pii.draw(b"k", "ipv4", "192.168.1.2", pii.LOOSE).startswith("10.")


def test_redrawn_entities_that_travel_with_their_documents(spark, monkeypatch):
    """A pool of 256 texts' emails, so that many are drawn again; held in memory or not, surrogates are the same and distinct."""
    texts = [f"mail {a}{b}@x.io and {b}{a}@x.io" for a in "abcdefgh" for b in "klmnopqr"] + [None, ""]
    held = changed(spark, texts)
    monkeypatch.setattr(pii, "HELD_ATTEMPTS", 0)
    assert changed(spark, texts) == held
    found = {w for t in held if t for w in t.split() if "@" in w}
    assert len(found) == 128 and not found & {w for t in texts if t for w in t.split() if "@" in w}
