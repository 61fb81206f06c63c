"""Suffix-array dedup, collocations and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from custgraph.llm import collocations, suffixes, variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, anchor long, piece long, word string, n int, key int, doc string, form string, _row int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, 1, 2, "w", 3, 4, "d", "f", 5) for i, t, g in rows], SCHEMA).repartition(5)


def removed(rows, length):
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    count = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = Counter()
    for i, t in texts:
        gone = np.zeros(len(t) + 2, int)
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k + 1 : k + length + 1] = 1
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out[i, len(t), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    return out


def passages():
    dice = random.Random(5)
    word = lambda: "".join(dice.choice("abcdeé日") for _ in range(dice.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, short, rows = text(120), text(60), []
    for i in range(60):
        rows.append((i, text(dice.randint(0, 90)) + (shared if i % 3 == 0 else "") + text(20) + (short if i % 2 else ""), "en"))
    rows += [(i, rows[i - 100][1], "en") for i in range(100, 110)] + [(200, None, None), (201, "", "en"), (None, rows[3][1], "en"), (3, rows[4][1], "en")]
    rows += [(210, "x" * 3000, "en"), (211, "xy" * 900 + "x" * 800, "en"), (212, "\0" * 900 + "a", "en"), (213, "x" * 399, "en"), (214, "q" * 400, "en")]
    rows += [(i, text(70) + " " + short[: 250 + i % 40] + text(70), "en") for i in range(300, 340)]
    rows += [(i, text(50) + shared[: 300 + 4 * (i % 40)] + text(50), "en") for i in range(400, 440)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard": 5000}, {"hot": 10}, {"hot": 2}, {"hot": 1}])
def test_bytes_of_repeated_strings_go(spark, sizes):
    rows = passages()
    got = suffixes.without_repeats(table(spark, rows), **sizes)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == removed(rows, 400)
    assert any(r[2] for r in removed(rows, 400))


def test_long_texts_are_cut_into_overlapping_spans(spark, monkeypatch):
    rows = passages()
    dice = random.Random(8)
    tail = "".join(dice.choice("abc ") for _ in range(9000))
    rows += [(500, tail, "en"), (501, "z" + tail[4000:6000], "en"), (502, "".join(r[1] or "" for r in rows), "en")]
    monkeypatch.setattr(suffixes, "SPAN", 2000)
    texts = [(t or "").encode() for _, t, _ in rows]
    seen = defaultdict(list)
    for data, of, place, ends in suffixes._spans(texts, 400):
        first, last, _ = suffixes._piece_runs(data, ends, 400)
        begins = np.concatenate([[0], ends[:-1]])
        span = np.searchsorted(ends, first, side="right")
        for s, a, b in zip(span, first, last):
            seen[int(of[s])] += range(a - begins[s] + place[s], b - begins[s] + place[s])
    for i, t in enumerate(texts):
        assert seen[i] == list(range(max(0, len(t) - 399)))
    # the workers have a SPAN of their own; a text beyond it
    big = [(1, tail * 70, "en"), (2, tail[:5000], "en"), (3, "".join(reversed(tail)), "en")]
    got = {r["doc_id"]: r["n_removed"] for r in suffixes.without_repeats(table(spark, big)).collect()}
    assert got == {1: 9000 * 70, 2: 5000, 3: 0}


def test_no_texts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffixes.without_repeats(empty).count() == 0
    assert collocations.collocations(empty).count() == 0
    assert variants.spelling_variants(empty).count() == 0
    blank = table(spark, [(1, None, None), (None, "", "en")])
    assert {tuple(r)[1:4] for r in suffixes.without_repeats(blank).collect()} == {(0, 0, 0)}
    assert collocations.collocations(blank).count() == 0
    assert variants.spelling_variants(blank).count() == 0


def test_suffix_ranks_and_windows():
    dice = random.Random(1)
    for _ in range(200):
        x = [dice.randint(1, dice.randint(1, 4)) for _ in range(dice.randint(1, 60))] + [0]
        assert np.argsort(suffixes.suffix_ranks(np.array(x))).tolist() == sorted(range(len(x)), key=lambda i: x[i:])
    for _ in range(200):
        length, letters = dice.randint(3, 20), b"\0abc"[: dice.randint(2, 4)]
        pieces = [bytes(dice.choice(letters) for _ in range(dice.randint(length, 80))) for _ in range(dice.randint(1, 6))]
        pieces = list({*pieces, pieces[0] + b"x", b"a" * dice.randint(length, 90)})
        count = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        want = [[count[p[i : i + length]] > 1 for i in range(len(p) - length + 1)] for p in pieces]
        assert [m.tolist() for m in suffixes.repeated_windows(pieces, length)] == want


def phrases(rows, least, best):
    found, totals, out = defaultdict(Counter), Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                found[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, f in found.items():
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in held.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        ranked = []
        for p, a in held.items():
            if not longer[p] or 100 * longer[p] < 80 * a:
                score, cut = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:best], 1):
            out[lang, rank, phrase.decode(), -a, left, right, totals[lang], -score] += 1
    return out


def prose():
    dice = random.Random(11)
    vocabulary = ["New", "york", "the", "é", "É", "日本", "\0", "a-b", "'s", "x" * 400, *[f"w{i}" for i in range(12)]]
    marks = [" ", "  ", "\t", ". ", ",", "\n", "\x0b", " ", " ", " "]
    rows = []
    for i in range(150):
        body = "".join(dice.choice(vocabulary) + dice.choice(marks) for _ in range(dice.randint(0, 200)))
        rows.append((i, body, dice.choice(["en", "en", "de", None, ""])))
    rows += [(i, rows[7][1], "en") for i in range(300, 340)] + [(400, None, "en"), (401, "", None), (None, " . ,\n", "de"), (7, "one", "en")]
    rows += [(500, "tick tock " * 20_000, "de"), (501, "tick tock tick", "en")]
    return rows


@pytest.mark.parametrize("period, bits, least, best", [(24, 1 << 27, 30, 2000), (2, 64, 5, 50), (10**6, 128, 3, 20)])
def test_collocations(spark, period, bits, least, best):
    rows = prose()
    got = collocations.collocations(table(spark, rows), least=least, best=best, period=period, most_bits=bits)
    assert Counter(tuple(r) for r in got.collect()) == phrases(rows, least, best)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_equal_chunks_are_one_row_and_overlaps_count_once(spark):
    rows = [(i, "a b c d e f g h i j k l m n o p " * 30, "en") for i in range(40)]
    parsed = collocations.dictionary(table(spark, rows).select("lang", "text"), period=4)
    assert sum(r["core"] * r["times"] for r in parsed.collect()) == 40 * 16 * 30
    assert parsed.count() < 40


def test_counts_beyond_64_bits_are_exact(spark):
    made = spark.sql("select cast(9000000000000000000 as bigint) as a, cast(9100000000000000000 as bigint) as l, cast(9200000000000000000 as bigint) as r")
    score = made.selectExpr("cast(a as decimal(19, 0)) * 2000000 div (cast(l as decimal(19, 0)) + r) as score").first()[0]
    assert score == 2000000 * 9 * 10**18 // (91 * 10**17 + 92 * 10**17)


def spelled(rows, every=199):
    count = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                count[run] += 1
    known = {w: n for w, n in count.items() if n >= 5}
    letters = {c for w in known for c in w}
    near = {}
    for w in known:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        near[w] = sorted((edits & set(known)) - {w}, key=lambda u: (-known[u], u))
    form = {w: u[0] for w, u in near.items() if u and known[u[0]] >= 5 * known[w]}
    out = Counter()
    for w, n in known.items():
        root = w
        while root in form:
            root = form[root]
        out[w, form.get(w), root, n, len(near[w]), known.get(form.get(w))] += 1
    return out


def spellings():
    dice = random.Random(4)
    base = ["abcdef", "abcdeg", "aaaaaa", "aaaaaaa", "aaaaaaaa", "çàéÿöü", "straße", "ÀÉÎÕÜÝ", "colour", "colours"]
    words = []
    for w in base:
        words += [w] * dice.randint(30, 400)
        for _ in range(25):
            v = list(w)
            for _ in range(dice.randint(1, 2)):
                at = dice.randrange(len(v))
                v[at : at + dice.randint(0, 1)] = [dice.choice("abcé")] * dice.randint(0, 1)
            words += ["".join(v)] * dice.randint(1, 60)
    dice.shuffle(words)
    rows = [(i, dice.choice([" ", "-", "1"]).join(words[i::200]), "en") for i in range(200)]
    return [*rows, (1, rows[0][1], "en"), (None, rows[1][1].upper(), "en"), (None, None, None), (900, "", "en"), (901, "x" * 20000 + " abcdeF" * 3000, "en")]


@pytest.mark.parametrize("block, every", [(2048, 199), (3, 2), (1, 199)])
def test_spelling_variants(spark, block, every):
    rows = spellings()
    got = variants.spelling_variants(table(spark, rows), block=block, every=every)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = spelled(rows, every)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert any(r[1] and r[2] != r[1] for r in want) or every == 2


def test_position_index():
    words = ["abcdef", "abcdeg", "abcdefg", "bcdefg", "abxdef", "abcdf", "abcedf", "zabcdef", "abcdefz"]
    index = variants.PositionIndex(words)
    found = index.near("abcdef")
    assert {w for i, w in enumerate(words) if found >> i & 1} == {"abcdeg", "abcdefg", "abxdef", "abcdf", "zabcdef", "abcdefz"}
    found = index.near("abcdef", shared=3)
    assert {w for i, w in enumerate(words) if found >> i & 1} == {"abxdef", "zabcdef"}
