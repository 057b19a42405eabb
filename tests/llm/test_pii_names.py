"""Names wherever they recur, titles without gender, and forms without a free surrogate."""

import re

import pytest
from pyspark.sql import functions as F

from cohortscope.llm import pii


def replaced(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in pii.replace(docs).orderBy("doc_id").collect()]


def test_a_name_is_replaced_wherever_its_words_recur(spark):
    one, two = replaced(
        spark, "Mrs Anna Smith called. Anna Smith said so, Dr. John Miller too. Smith's dog; ANNA, Annabel.", "Miss Anna, Mr Smith")
    first, last = re.fullmatch(r"Miss (\w+), Mr (\w+)", two).groups()
    assert {first, last}.isdisjoint({"Anna", "Smith"})
    found = re.match(r"Mrs (\w+) (\w+) called\. (\w+) (\w+) said so, Dr\. (\w+) (\w+) too\. (\w+)'s dog; ANNA, Annabel\.$", one)
    given, surname, given_again, surname_again, john, miller, alone = found.groups()
    assert given == given_again and surname == surname_again == alone == last
    assert given.endswith("na") and not {"Anna", "Smith", "John", "Miller"} & {given, surname, john, miller}


def test_ordinary_words_behind_a_title_stay_elsewhere(spark):
    (text,) = replaced(spark, "Miss World and the world. World peace.")
    assert re.fullmatch(r"Miss \w+ and the world\. World peace\.", text) and "Miss World" not in text


def test_texts_without_names_are_as_before(spark):
    assert replaced(spark, "Smith was here.", "") == ["Smith was here.", ""]


@pytest.mark.parametrize("text", ["Mr O'Neil-Smith met O'Neil-Smith.", "Frau Müller; Müller", "Госпожа Анна Иванова. Анна!", "Mr Smith Smith. Smith"])
def test_words_with_marks_and_other_scripts(spark, text):
    (got,) = replaced(spark, text)
    names = re.findall(r"[^\W\d_][\w'-]*", text)
    assert got != text and not set(re.findall(r"[^\W\d_][\w'-]*", got)) & {n for n in names if names.count(n) > 1}


def test_short_addresses_find_free_surrogates(spark):
    texts = [f"{digit}@{host}.co" for digit in range(10) for host in "abcdefghijklmnopqrstuvwxyz"]
    got = replaced(spark, *texts)
    assert len(set(got)) == len(texts) and not set(got) & set(texts)
    assert all(re.fullmatch(r"\d[a-z]*@[a-z]\.co", t) for t in got)


def test_a_form_without_free_values_stops_the_run(spark, monkeypatch):
    monkeypatch.setattr(pii, "_characters", lambda form, drawn, first: F.concat(F.substring(form, 1, 2), F.lit("7777777")))
    monkeypatch.setattr(pii, "MAX_ATTEMPTS", 2)
    with pytest.raises(ValueError, match=r"no free surrogate after 2 draws: ssn \(\d+\)"):
        replaced(spark, *[f"ssn 12{i}-00-0000" for i in range(9)])
