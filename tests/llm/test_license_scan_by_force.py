"""Base columns of the licence scan against every place of every phrase, on awkward rows and a whole table."""

from __future__ import annotations

import random
import re

import pytest

from millrace.llm import license_scan
from millrace.llm.queries import QUERIES
from test_operators import frame, lower, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = "/root/testdata/sf0.001"


def base(text):
    words = WORD.findall(lower(text or ""))
    found = [
        (i, label) for phrase, label in license_scan.PHRASES for i in range(len(words))
        if words[i:i + len(phrase.split())] == phrase.split()
    ]
    places = [i for i, _ in found]
    return (len(words), len(found), min(places, default=None), max(places, default=None),
            ",".join(sorted({label for _, label in found})))


def held(rows):
    return sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows), key=repr)


def test_base_columns_equal_every_place(spark):
    rng = random.Random(11)
    parts = ["MIT License", "mit-license", "Apache  license.", "the GNU General Public License", "general public", "license", "mit mit license é"]
    texts = [None, "", " \n", "mit", "license mit", "MIT\tLICENSE", "général public license", "mitlicense"]
    texts += [" ".join(rng.choice([*parts, "and", "x"]) for _ in range(n)) for n in (2, 5, 20, 200)]
    texts += [prose(rng, 40_000, 500) + " mit license", "mit license " * 20_000]
    rows = list(enumerate(texts)) + [(3, "mit license"), (3, "mit license"), (3, "gpl"), (None, "Apache License"), (None, "mit license")]
    found = license_scan.scan(frame(spark, rows)).collect()
    assert held(found) == sorted(((i, *base(t)) for i, t in rows), key=repr)
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= {"", *r["labels"].split(",")} for r in found)


@pytest.mark.parametrize("table", [SMALL])
def test_base_columns_of_a_whole_table(spark, table):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{table}/documents.parquet").collect()]
    assert held(QUERIES["op6_license_scan"](spark, table).collect()) == sorted(((i, *base(t)) for i, t in docs), key=repr)
