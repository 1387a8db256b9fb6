"""Filter audit, importance resampling and personal data on awkward rows, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import pyarrow as pa
import pytest

from millrace.llm import byte_spans, filter_audit, importance, personal_data
from millrace.llm.queries import QUERIES
from test_operators import frame, lower, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = "/root/testdata/sf0.001"


def awkward(seed=9):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "one", "One TWO", "É é日 É", "#", "x" * 5000, "same text $", "same text $", "same text $"]
    texts += [prose(rng, n, v) for n, v in ((19, 9), (20, 9), (120, 9), (120, 5000), (3000, 40), (60_000, 300))]
    texts += ["AB CD " * 70, "w" * 70 + "a " + "w" * 70 + "b " + "w" * 70 + "a"]
    return list(enumerate(texts, 5)) + [(8, "one"), (8, "two"), (None, "one"), (None, "same text $"), (7, " \t\n")]


# Words as spans

@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_counts_and_features_do_not_depend_on_the_pieces(monkeypatch, size):
    rng = random.Random(size)
    signs = ["a", "B", "é", "#", "日", "𝒳", " ", "\n", "--", "x" * 70, "y" * 90 + "z", "\x00", "\x1f", "\xa0", " "]
    monkeypatch.setattr(byte_spans.pieces, "__defaults__", (size,))
    for _ in range(60):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(50))) for _ in range(rng.randrange(9))]
        data, offsets = byte_spans.utf8_buffer(pa.array(texts, pa.string()))
        found = filter_audit.Counts(data, offsets)
        runs = [Counter() for _ in texts]
        for buckets, which, whose in importance.features(data, offsets):
            for k, of in zip(which, whose):
                runs[of][int(buckets[k])] += 1
        for i, text in enumerate(texts):
            words = WORD.findall(text)
            assert (found.words[i], found.distinct[i], found.points[i]) == (len(words), len(set(words)), len(text))
            assert found.capitals[i] == len(re.findall("[A-Z]", text)) and found.symbols[i] == text.count("#")
            assert runs[i] == feature_buckets(text)


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(byte_spans.Spans, "_hashes", lambda self, starts, lengths, owners: owners.astype("u8") * 0)
    texts = ["ab cd ab ef ab", "ab " + "q" * 80 + "r " + "q" * 80 + "s " + "q" * 80 + "r"]
    data, offsets = byte_spans.utf8_buffer(pa.array(texts))
    assert filter_audit.Counts(data, offsets).distinct.tolist() == [3, 3]


# Filter audit

def failed(rows):
    found = []
    for i, text in rows:
        t = text or ""
        words = WORD.findall(t)
        same = [j for j, other in rows if (other or "") == t and j is not None and i is not None and j < i]
        tests = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), bool(same)]
        found.append((i, "".join(x for x, bad in zip("ABCDE", tests) if bad)))
    return found


def audited(rows, part_of, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out, marks = {}, failed(rows)
    for part in {part_of(i) for i, _ in rows}:
        mine = [(i, f) for i, f in marks if part_of(i) == part]
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            for step, it in enumerate(order, 1):
                gone = lambda f, n: bool(set(f) & set(order[:n]))
                here = [i for i, f in mine if it in f and not gone(f, step - 1)]
                total[it] += len(here)
                out[part, order, step] = [
                    sum(not gone(f, step) for _, f in mine), len(here),
                    sum(it in f and gone(f, step - 1) for _, f in mine), sum(f == it for _, f in mine),
                    sum(i in good for i in here), sum(i in toxic for i in here),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def test_audit_equals_brute_force(spark):
    rows, labels = awkward(), [(5, 1, 0), (8, 0, 1), (8, 1, None), (13, 1, 1), (99, 1, 1), (None, 1, 1), (9, None, 0)]
    docs = frame(spark, rows).selectExpr("* except (lang)", "if(doc_id % 2 = 0, 'en', null) as lang", "'z' as fails", "'f' as first")
    part_of = lambda i: "en" if i is not None and i % 2 == 0 else ""
    found = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    mine = {(r["part"], r["filter_order"], r["step"]): list(r[3:]) for r in found}
    assert len(found) == len(mine) == 2 * 600
    assert mine == audited(rows, part_of, labels)


def test_audit_of_empty_tables(spark):
    none = frame(spark, [(1, "x")]).where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(none, labels).count() == 0
    assert filter_audit.audit(frame(spark, [(1, "x")]), labels).agg({"good_lost": "max"}).first()[0] == 0


# Importance resampling

def feature_buckets(text):
    words, found = NAMED.findall(lower(text or "")), Counter()
    for n in (1, 2, 3):
        for j in range(len(words) - n + 1):
            found[zlib.crc32(" ".join(words[j:j + n]).encode()) % 10_000] += 1
    return found


def drawn(rows, target, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, text in rows:
        s += feature_buckets(text)
    for _, text in target:
        t += feature_buckets(text)
    s_all, t_all = float(sum(s.values()) + 10_000), float(sum(t.values()) + 10_000)
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all)))
    out = []
    for i, text in rows:
        found = feature_buckets(text)
        weight = sum(n * gain(b) for b, n in found.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, sum(found.values()), weight, score, len(NAMED.findall(lower(text or "")))])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): n for n, r in enumerate(able[:percent * len(able) // 100], 1)}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=repr)


@pytest.mark.parametrize("percent", [5, 50, 100])
def test_resample_equals_brute_force(spark, percent):
    rng = random.Random(percent)
    rows = awkward() + [(100 + i, prose(rng, rng.randrange(10, 60), 200)) for i in range(150)]
    target = [(0, prose(rng, 300, 50)), (1, None), (1, "W1 w2")]
    found = importance.resample(frame(spark, rows), frame(spark, target).withColumnRenamed("doc_id", "item_id"), percent)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=repr) == drawn(rows, target, percent)


def test_resample_ranks_ties_and_repeats_by_id(spark):
    same = prose(random.Random(1), 30)
    rows = [(3, same)] * 40 + [(i, same) for i in range(4, 24)]
    found = importance.resample(frame(spark, rows), frame(spark, []), 50).where("rank is not null").collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 31))
    order = sorted(found, key=lambda r: r["rank"])
    assert [(-r["score"], r["doc_id"]) for r in order] == sorted((-r["score"], r["doc_id"]) for r in found)


def test_resample_of_empty_tables(spark):
    none = frame(spark, [(1, "x")]).where("false")
    assert importance.resample(none, none).count() == 0
    assert importance.resample(frame(spark, [(1, "x y"), (2, None)]), none).where("rank is null").count() == 2


# Personal data

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {
        "email": True, "ip": all(int(p) <= 255 for p in text.split(".")) if kind == "ip" else None,
        "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15,
    }[kind]


def base_spans(text):
    return [(k, *m.span()) for k, p in BASE.items() for m in p.finditer(text or "") if holds(k, m[0])]


def base_of(spans):
    return [tuple(s) for s in spans if s[0] in BASE]


def test_base_kinds_equal_their_patterns():
    rng, scanner = random.Random(4), personal_data.Scanner()
    signs = [*"aZ9.@%+- ()1205é", "https://", "iban ", "İ", "255.", "4785380592391139", "account no. ", "token=", "+1 (555) 555-1234"]
    for _ in range(20_000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(30)))
        assert base_of(scanner.scan(text)) == base_spans(text)


@pytest.mark.parametrize("text, kind, what", [
    ("IBAN: DE89 3704 0044 0532 0130 00 is mine", "iban", "DE89 3704 0044 0532 0130 00"),
    ("iban DE89370400440532013000.", "iban", "DE89370400440532013000"), ("iban DE88 3704 0044 0532 0130 00", "iban", None),
    ("iban DE893704004405320130001", "iban", None),
    ("Account number: 123-456-789.", "account", "123-456-789"), ("accounts 123456789", "account", None), ("account 12345", "account", None),
    ("SSN 123-45-6789", "ssn", "123-45-6789"), ("ssn 666-45-6789", "ssn", None), ("ssn 123-45-67890", "ssn", None),
    ("(see https://a.example.com/x?y=1).", "url", "https://a.example.com/x?y=1"), ("http:// x", "url", None),
    ('token = "f33e61083db5dbdf"', "secret", "f33e61083db5dbdf"), ("tokens = abcdefghij", "secret", None), ("password: short", "secret", None),
])
def test_added_kinds(text, kind, what):
    found = [text[a:b] for k, a, b in personal_data.Scanner().scan(text) if k == kind]
    assert found == ([what] if what else [])


def test_many_anchors_take_linear_time():
    scanner = personal_data.Scanner()
    for part in ("token=", "http://a/", "a@", "+1", "1.", "1 ", "iban de12", "account 1"):
        scanner.scan(part * 100_000)


def test_find_and_redact(spark):
    rows = awkward() + [(200, "mail é.x@b.example and +1 (743) 555-3824, 1.2.3.4.5"), (200, "1.2.3.256"), (201, "x@y.z" * 3)]
    found = personal_data.find(frame(spark, rows)).collect()
    assert sorted(((r[0], base_of(r[1])) for r in found), key=repr) == sorted(((i, base_spans(t)) for i, t in rows), key=repr)
    assert personal_data.find(frame(spark, [])).count() == 0
    clean = personal_data.without_personal_data(frame(spark, [(1, "a@b.c, 1.2.3.4"), (2, None)])).collect()
    assert sorted(map(tuple, clean)) == [(1, "[email], [ip]"), (2, None)]


def test_personal_data_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op13_personal_data"](spark, SMALL).collect()
    assert len(found) == len(docs) and any(r["n_email"] for r in found)
    for r in found:
        wanted = base_spans(docs[r["doc_id"]])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in wanted)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(k == x for x, _, _ in wanted) for k in BASE]
        assert [s for s in r["spans"].split(",") if s and s.split(":")[0] in BASE] == [s for s in listed.split(",") if s]
