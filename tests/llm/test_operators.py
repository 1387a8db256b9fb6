"""The text operators on small fixtures with awkward rows, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import time
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from millrace.llm import (
    chat_format, common, components, decontamination, exact_dedup, jaccard_join, language_id, license_scan, line_dedup,
    rolling, sentencepiece_bpe, substring_dedup, toxicity,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Extra columns carry the names that the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, hash string, key string, body string, "
          "label long, group int, words string, kept boolean, n_words long")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def frame(spark, rows):
    full = [(i, t, "en", None, None, "h", "k", None, 1, 2, "w", None, None) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base, passage = prose(rng, 120, 5000), prose(rng, 40, 9000)
    near = base.split()
    near[60] = "changed"
    out = [base, base.upper(), " ".join(near), base + " tail", passage, f"{prose(rng, 30)} {passage} {prose(rng, 30)}"]
    out += [f"{passage}\n{passage}", "", None, " \t\n", "one", "one two", "One  TWO", "one two", "É é É é É"]
    out += ["the same long line here\nunique a\nThe Same Long Line Here  ", "unique b\nthe same long line here\n\n", "x" * 5000]
    out += [prose(rng, n, 40) for n in (3, 14, 200, 3000)]
    return list(enumerate(out, 10))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_groups(spark, texts):
    rows = [*texts, (10, texts[0][1]), (None, "one two")]
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t or "")].append(i)
    for keep, pick in (("largest", max), ("smallest", min)):
        found = exact_dedup.exact_groups(frame(spark, rows), keep=keep, ascii_case=True)
        wanted = []
        for text, ids in groups.items():
            best = pick(i for i in ids if i is not None)
            wanted += [(i, best, len(ids), i == best, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
        assert rows_of(found) == sorted(wanted, key=repr)
    kept = exact_dedup.without_copies(frame(spark, texts))
    assert kept.columns == frame(spark, []).columns
    assert kept.count() == len({t or "" for _, t in texts})
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def brute_lines(rows):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    first = {}
    for i, t in rows:
        for k in map(key, (t or "").split("\n")):
            if i is not None and len(k) >= 10:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(key(x)) < 10 or first[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 5])
def test_line_dedup(spark, texts, batches):
    rows = [*texts, texts[0], (None, texts[0][1])]
    assert rows_of(line_dedup.dedup_lines(frame(spark, rows), batches=batches)) == brute_lines(rows)


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_line_runs_are_compacted(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for n in range(4):
        runs.add(spark.range(n * 3, n * 3 + 3).select(F.col("id").alias("high"), F.col("id").alias("low")))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    keys = spark.range(10, 14).select(F.col("id").alias("high"), F.col("id").alias("low"))
    assert {r["high"]: r["seen"] for r in runs.mark(keys).collect()} == {10: True, 11: True, 12: False, 13: False}


def brute_windows(rows, k):
    words = [WORD.findall(t or "") for _, t in rows]
    late = float("inf")
    first = {}
    for (i, _), w in zip(rows, words):
        for p in range(len(w) - k + 1):
            s = tuple(w[p:p + k])
            first[s] = min(first.get(s, late), late if i is None else i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for p in range(len(w) - k + 1):
            if first[tuple(w[p:p + k])] < (late if i is None else i):
                gone.update(range(p, p + k))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("k", [2, 13])
def test_substring_dedup(spark, texts, k):
    rows = [*texts, texts[5], (None, texts[0][1]), (-3, texts[6][1])]
    found = substring_dedup.remove_repeats(frame(spark, rows), k=k).collect()
    mine = [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["removed"]), r["kept"]) for r in found]
    assert sorted(mine, key=repr) == brute_windows(rows, k)
    assert substring_dedup.remove_repeats(frame(spark, []), k=k).count() == 0


def test_substring_dedup_in_small_pieces(spark, texts, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HELD_WINDOWS", 1)
    rows = texts * 1
    found = substring_dedup.digests(substring_dedup.remove_repeats(frame(spark, rows))).collect()
    assert {r["doc_id"]: r["n_removed"] for r in found} == {i: n for i, _, n, _ in brute_windows(rows, 13)}


@pytest.mark.parametrize("held", [1, 4_000_000])
def test_substring_dedup_of_rows_without_id_and_ids_with_two_texts(spark, texts, monkeypatch, held):
    monkeypatch.setattr(substring_dedup, "HELD_WINDOWS", held)
    rng = random.Random(11)
    passage, alone = texts[4][1], [prose(rng, 90, 9000) for _ in range(6)]
    rows = [
        *texts, (None, f"{passage} {alone[0]}"), (None, alone[1]), (None, f"{alone[2]} {passage}"), (None, alone[1]), (None, None),
        (7000, f"{passage} {alone[3]}"), (7000, alone[4]), (7000, f"{alone[5]} {passage}"), (7001, alone[4]),
    ]
    found = substring_dedup.remove_repeats(frame(spark, rows)).collect()
    mine = [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["removed"]), r["kept"]) for r in found]
    assert sorted(mine, key=repr) == brute_windows(rows, 13)


def test_substring_dedup_spreads_rows_without_id(spark):
    rows = frame(spark, [(None, f"text {n}") for n in range(300)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = substring_dedup.remove_repeats(rows).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in dealt) < 300


@pytest.mark.parametrize("held", [1, 4_000_000])
def test_substring_dedup_dealt_in_two_turns(spark, texts, monkeypatch, held):
    monkeypatch.setattr(rolling, "FAN", 5)
    monkeypatch.setattr(substring_dedup, "HELD_WINDOWS", held)
    rows = [*texts, texts[5], (None, texts[0][1]), (None, f"{texts[4][1]} end"), (-3, texts[6][1])]
    found = substring_dedup.remove_repeats(frame(spark, rows)).collect()
    mine = [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["removed"]), r["kept"]) for r in found]
    assert sorted(mine, key=repr) == brute_windows(rows, 13)


def test_a_hold_of_windows_costs_by_its_rows_not_by_the_buckets():
    rng = np.random.default_rng(3)
    hashes, ids = rng.integers(0, 1 << 63, 300).astype(np.uint64), np.arange(300, dtype=np.int64)
    group = rng.integers(0, 1 << 30, 300).astype(np.uint32)
    for work in (
        lambda n: list(substring_dedup._sent(np.repeat(hashes, 2), np.r_[ids, ids], np.r_[group, group], n, n)),
        lambda n: list(jaccard_join._by_group(ids, n, hashes)),
    ):
        times = []
        for buckets in (100, 100_000, 2_000_000_000):
            begun = time.perf_counter()
            work(buckets)
            times.append(time.perf_counter() - begun)
        assert times[2] < 10 * times[1] + 0.1


def brute_components(rows, k, percent):
    sets, parent = {}, {}
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[i] = {tuple(w[p:p + k]) for p in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard_components(spark, texts, k, percent):
    rng = random.Random(k)
    family = prose(rng, 100, 3000).split()
    more = []
    for i in range(40):  # a family whose members stray from each other
        words = list(family)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(100)] = f"new{rng.randrange(30)}"
        more.append((1000 - i, " ".join(words)))
    rows = [*texts, *more]
    found = jaccard_join.jaccard_components(frame(spark, rows), k=k, percent=percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == brute_components(rows, k, percent)


def test_jaccard_components_dealt_in_two_turns(spark, texts, monkeypatch):
    monkeypatch.setattr(rolling, "FAN", 5)
    monkeypatch.setattr(jaccard_join, "HELD_TOKENS", 500)
    rows = [*texts, (9, texts[2][1])]
    found = jaccard_join.jaccard_components(frame(spark, [*rows, (None, "one two"), (None, "one two three")]), k=3, percent=90)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.where("doc_id is not null").collect()} == (
        brute_components(rows, 3, 90)
    )
    assert found.where("doc_id is null and component_id is null").count() == 2


def test_jaccard_rows_without_id_and_repeated_rows(spark, texts):
    rows = [*texts[:4], texts[0], (None, texts[0][1])]
    found = jaccard_join.jaccard_components(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in found)[10, 10] == 2
    assert [r["component_id"] for r in found if r["doc_id"] is None] == [None]
    assert jaccard_join.one_of_each(frame(spark, rows)).count() == 3
    assert jaccard_join.jaccard_components(frame(spark, [])).count() == 0


@pytest.fixture(scope="module")
def divided():
    """Rows of which some ids have several texts, near copies of different other texts."""
    rng = random.Random(21)
    bases = [prose(rng, n, 6000).split() for n in (60, 90, 130, 70, 80)]

    def near(b, word=None):
        words = list(bases[b])
        words[-1] = word or "changed"
        return " ".join(words)

    rows = [(n, " ".join(w)) for n, w in enumerate(bases[:3], 1)]
    rows += [(50, near(0)), (50, near(1)), (50, near(2)), (50, " ".join(bases[3])), (60, near(3)), (60, near(2, "again"))]
    rows += [(70, " ".join(bases[4])), (70, " ".join(bases[4])), (70, None), (71, near(4)), (None, near(4)), (None, near(0)), (3, near(1, "again"))]
    return rows


def brute_rows(rows, k=3, percent=90):
    """(id, n_shingles, component) of each row, every row being a set of its own."""
    numbered = brute_components(list(enumerate(t for _, t in rows if _ is not None)), k, percent)
    ids = [i for i, _ in rows if i is not None]
    least = {}
    for n, (_, root) in numbered.items():
        least[root] = min(least.get(root, ids[n]), ids[n])
    return [(ids[n], size, least[root]) for n, (size, root) in numbered.items()]


def test_jaccard_components_of_ids_with_several_texts(spark, divided):
    found = jaccard_join.jaccard_components(frame(spark, divided)).where("doc_id is not null")
    assert rows_of(found) == sorted(brute_rows(divided), key=repr)


def test_one_of_each_of_ids_with_several_texts(spark, divided):
    rows = [(i, t) for i, t in divided if i is not None]
    wanted = [(i, t) for (i, t), (_, _, low) in zip(rows, brute_rows(rows)) if low == i] + [r for r in divided if r[0] is None]
    kept = jaccard_join.one_of_each(frame(spark, divided))
    assert kept.columns == frame(spark, []).columns
    assert rows_of(kept.select("doc_id", "text")) == sorted(wanted, key=repr)


@pytest.mark.parametrize("block,part", [(256, 1000), (4, 7)])
def test_jaccard_links_loses_no_link(spark, texts, divided, monkeypatch, block, part):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "LIST_PART", part)
    rng, rows = random.Random(8), [*texts, *divided]
    family = prose(rng, 200, 3000).split()
    for i in range(30):
        words = list(family)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(200)] = f"new{rng.randrange(30)}"
        rows.append((1000 + i, " ".join(words)))
    sets = []
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        sets.append(frozenset(tuple(w[p:p + 3]) for p in range(len(w) - 2)) if len(w) >= 3 else frozenset({tuple(w)} - {()}))
    kinds = {s for s, (i, _) in zip(sets, rows) if s and i is not None}
    linked = {s: sum(s != o and 100 * len(s & o) >= 90 * len(s | o) for o in kinds) for s in kinds}
    links, members = jaccard_join.jaccard_links(frame(spark, rows))
    found = members.collect()
    wanted = [(i, len(s), linked[s] if i is not None and s else 0) for s, (i, _) in zip(sets, rows)]
    assert sorted(((r["doc_id"], r["n_shingles"], r["n_links"]) for r in found), key=repr) == sorted(wanted, key=repr)
    assert len({r["class_id"] for r in found} - {None}) == len(kinds)
    pairs = {(r["a"], r["b"]) for r in links.collect()}
    assert len(pairs) == links.count() == sum(linked.values()) // 2 and all(a < b for a, b in pairs)
    assert sum(linked.values()) // 2 > len(kinds)


def test_divide_skip_finds_what_a_scan_finds():
    rng = random.Random(1)
    sets = []
    for _ in range(60):
        base = set(rng.sample(range(300), 60)) if not sets or rng.random() < 0.3 else set(sets[-1].tolist())
        base ^= set(rng.sample(range(300), rng.randrange(6)))
        sets.append(np.array(sorted(base), np.uint64))
    index = jaccard_join.BlockIndex(sets, 80)
    for x, mine in enumerate(sets):
        wanted = [
            y for y, s in enumerate(sets)
            if y != x and 100 * len(np.intersect1d(mine, s)) >= 80 * len(np.union1d(mine, s))
        ]
        assert sorted(index.linked(x, [y != x for y in range(60)])) == wanted


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(n + 1, n) for n in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r["node"]: r["label"] for r in components.components(links).collect()}
    assert found == {**{n: 0 for n in range(41)}, 100: 100, 101: 100}


def test_decontamination(spark, texts):
    items = [(1, texts[4][1]), (2, "one two"), (3, None), (4, " ".join(texts[0][1].split()[:12])), (5, "never seen words here at all"),
             (None, " ".join(texts[3][1].split()[20:40])), (None, "one two"), (0, "two")]
    rows = [*texts, (None, "one two"), (None, "One two!"), (None, texts[0][1]), (None, None), (0, "clean text")]
    bench = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id long")
    found = decontamination.contained_items(frame(spark, rows), bench)

    def words(text):
        return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]

    wanted, leaking = [], set()
    for i, item in items:
        w = words(item)
        size = min(5, len(w))
        grams = {tuple(w[p:p + size]) for p in range(len(w) - size + 1)} if w else set()
        for d, text in rows:
            v = words(text)
            both = len(grams & {tuple(v[p:p + size]) for p in range(len(v) - size + 1)})
            if grams and 100 * both >= 80 * len(grams):
                wanted.append((d, i, len(grams), both))
                leaking.add((d, text))
    assert sorted((tuple(r)[:4] for r in found.collect()), key=repr) == sorted(wanted, key=repr)
    clean = decontamination.without_leaks(frame(spark, rows), bench).select("doc_id", "text")
    assert rows_of(clean) == sorted((r for r in rows if r not in leaking), key=repr)
    assert decontamination.contained_items(frame(spark, texts), bench.limit(0)).count() == 0
    assert decontamination.contained_items(frame(spark, []), bench).count() == 0


HARD = [
    "", " ", "  a", "a  b   c ", "▁a ▁▁ b", "\n\n\ta\r\nb", "<s>x</s> <0x41> <unk>", "é́ 😀  漢字かな", "\x00a", "Hello, World! " * 50,
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "=" * 300, " " * 200, "x" * 20000, "theofanding" * 40, None,
]


def test_sentencepiece_equals_the_library(spark):
    rng = random.Random(9)
    letters = "abcdefgehinorst  .,\n▁éß漢<>/_=01"
    rows = list(enumerate(HARD + ["".join(rng.choices(letters, k=rng.randrange(1, 120))) for _ in range(300)]))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in sentencepiece_bpe.tokenize(frame(spark, rows), MODEL).collect():
        ids = library.encode(rows[r["doc_id"]][1] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["decoded"] == library.decode(ids)
    assert sentencepiece_bpe.tokenize(frame(spark, []), MODEL).count() == 0


def test_sentencepiece_with_a_full_store(monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "KEPT_WORDS", 3)
    codec = sentencepiece_bpe.Codec(sentencepiece_bpe.Vocabulary(MODEL))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "every word of this line is encoded although the store of words is tiny"
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)


def chat(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")


def test_chat_formatting_reads_back(spark):
    said = "</s>[INST] ok [/INST]\\. \\ <|end|>\n<|role|>"
    rows = [(1, 2, "assistant", said, "z"), (1, 1, "user", said, None), (1, 1, "user", said, None), (2, None, None, None, None),
            (None, 1, "assistant", "x", None), (None, 1, "assistant", "x", None), (None, 2, "user", "y", None)]
    chats = chat_format.format_conversations(chat(spark, rows))
    alone = [r["turns_text"] for r in chat_format.read_back(chats.where("conv_id is null")).collect()]
    assert sorted(alone) == ["assistant\nx\n"] * 2 + ["user\ny\n"]
    back = {r["conv_id"]: r for r in chat_format.read_back(chats.where("conv_id is not null")).collect()}
    assert back[1]["turns_text"] == f"user\n{said}\n" * 2 + f"assistant\n{said}\n"
    assert back[1]["loss_text"] == said and back[1]["n_turns"] == 3
    assert back[2]["turns_text"] == "\n\n"
    for r in chats.collect():
        inner = re.sub(r"<\|(role|text|end)\|>", "", r["formatted"])
        assert not any(c in inner for c in chat_format.CONTROLS)
        assert [s["end"] for s in r["turns"]][:-1] == [s["start"] for s in r["turns"]][1:]
    assert chat_format.format_conversations(chat(spark, [])).count() == 0


def test_templates_that_rewrite_history(spark):
    def last_only(turns):
        return "".join(f"<{t if i == len(turns) - 1 else '...'}>" for i, (_, t) in enumerate(turns))

    text, found, rewrites = chat_format.spans([("user", "abc"), ("assistant", "def")], last_only)
    assert (text, rewrites) == ("<...><def>", True)
    assert found == [(0, 1), (1, 10)]
    rows = [(1, 0, "user", "abc", None), (1, 1, "assistant", "def", None)]
    assert chat_format.format_conversations(chat(spark, rows), render=last_only).first()["rewrites"]


def test_license_scan(spark):
    rows = [
        (1, "Released under the MIT License. mit  LICENSE"), (2, "the general\npublic-license of Apache License"),
        (3, None), (4, ""), (5, "mit licenses general public"), (1, "MIT License"), (None, "mit license"),
        (6, "This program is free software: you can redistribute it and/or modify it under the terms of a GNU general public license"),
        (7, "mit " * 300 + "license"),
    ]
    found = license_scan.scan(frame(spark, rows)).collect()
    for r in found:
        assert 0 <= r["score"] <= 1
    by = {(r["doc_id"], r["n_words"]): r for r in found}
    assert tuple(by[1, 7])[2:7] == (2, 3, 5, "mit", "mit,mit-notice")
    assert tuple(by[2, 7])[2:6] == (2, 1, 5, "apache,gpl")
    assert tuple(by[3, 0])[2:] == (0, None, None, "", "", 0.0)
    assert by[5, 4]["n_base"] == 0 and by[1, 2]["n_base"] == 1 and by[None, 2]["n_base"] == 1
    assert by[6, 22]["labels"] == "gpl,gpl-text"
    assert (by[7, 301]["n_base"], by[7, 301]["first_word"]) == (1, 299)
    assert license_scan.scan(frame(spark, [])).count() == 0


def labelled(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(240):
        words = prose(rng, 40, 300).split()
        if i % 4 == 0:
            words[rng.randrange(40)] = rng.choice(["horrible", "dreadful"])
            words[rng.randrange(40)] = rng.choice(["horrible", "dreadful"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0), "en"))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, text string")


@pytest.mark.parametrize("slot_bits", [1, 3, 16])
def test_smallest_hashes(spark, slot_bits):
    ids = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 9, "few").otherwise("many").alias("name"))
    rows = ids.withColumn("rank", F.xxhash64("doc_id")).unionByName(ids.limit(2).withColumn("rank", F.xxhash64("doc_id")))
    wanted = []
    for name in ("few", "many"):
        wanted += sorted((r["rank"], r["doc_id"]) for r in rows.where(F.col("name") == name).collect())[:20]
    got = common.smallest_hashes(rows, "name", "doc_id", 20, slot_bits).collect()
    assert sorted((r["rank"], r["doc_id"]) for r in got) == sorted(wanted)
    assert common.smallest_hashes(rows.limit(0), "name", "doc_id", 20, slot_bits).count() == 0


def test_toxicity(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels, F.col("doc_id") % 5 != 0, epochs=40)
    rng = random.Random(3)
    clean, bad = prose(rng, 30, 300), prose(rng, 30, 300) + " horrrible dreadfull dreadful horribly"
    fresh = frame(spark, [(1, clean), (2, bad), (3, None), (4, ""), (5, "..."), (None, bad)])
    got = {r["doc_id"]: r["score"] for r in toxicity.score(fresh, model).collect()}
    assert got[1] < 0.5 < got[2] == got[None]
    assert got[3] == got[4] == got[5]
    kept = {r["doc_id"] for r in toxicity.without_toxic(fresh, model).collect()}
    assert {1} <= kept and not {2, None} & kept
    assert toxicity.train(docs, labels.limit(0), F.lit(True)) is None
    assert [r["score"] for r in toxicity.score(fresh, None).collect()] == [0.0] * 6
    assert toxicity.score(frame(spark, []), model).count() == 0


def test_toxicity_training_keeps_bags_only(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(1200)) for _ in range(80)]
    docs = frame(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "TRAINING_WORDS", 1000, raising=False)
    tracemalloc.start()
    try:
        model = toxicity.train(docs, labels, F.lit(True), epochs=1, batch=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 30e6
    monkeypatch.undo()
    # Rows that come twice, their order and the bound on kept words change nothing.
    again = toxicity.train(docs.unionByName(docs).repartition(5), labels, F.lit(True), epochs=1, batch=2)
    assert (again.embeddings == model.embeddings).all() and (again.weights == model.weights).all() and again.bias == model.bias


def test_language_id(spark):
    rng = random.Random(4)
    sound = {"de": "sch ung ein ver heit keit ö ü".split(), "es": "ción mente que los ó ñ ado arr".split()}

    def speak(lang, n):
        return " ".join("".join(rng.choices(sound[lang], k=3)) for _ in range(n))

    rows = [(i, speak(lang, 60), lang) for i, lang in enumerate(["de", "es"] * 20)] + [(90, "123", None), (91, None, "de")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    content = language_id.train(docs, F.col("doc_id") < 30)
    got = {r["doc_id"]: r for r in language_id.identify(docs, content).collect()}
    assert all(got[i]["lang"] == lang for i, _, lang in rows[30:40])
    assert got[90]["lang"] == got[91]["lang"] == "und" and got[90]["narrow"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language_id.train(docs.limit(0), F.lit(True)) == {}
    assert {r["lang"] for r in language_id.identify(docs, {}).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), content).count() == 0
