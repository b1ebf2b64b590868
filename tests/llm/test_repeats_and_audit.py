"""Repetition rules, the filter audit and periodic runs against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from brindle.llm import filter_audit, grammar, periodic_runs, repetition
from tests.llm import plain

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def sequences(seed, n=200):
    """Groups of short sequences over few symbols, many of them with repeats."""
    rng = random.Random(seed)
    for _ in range(n):
        group = []
        for _ in range(rng.randint(1, 5)):
            s = [rng.randrange(rng.randint(1, 5)) for _ in range(rng.randint(0, 30))]
            if s and rng.random() < 0.6:
                s = s + s[: rng.randint(1, len(s))] * rng.randint(1, 9) + s
            group.append(s)
        yield group, np.array(sum(group, []), np.int64), np.cumsum([0] + [len(s) for s in group])


def test_suffix_arrays_and_maximal_repeats():
    for group, ids, first in sequences(1):
        order = repetition.suffix_array(ids, first)
        common = repetition.common_prefixes(ids, first, order)
        expected_order, expected_common, expected = [], [], []
        for t, s in enumerate(group):
            by = sorted(range(len(s)), key=lambda p: s[p:])
            for k, p in enumerate(by):
                m, q = 0, by[k - 1]
                while k and max(p, q) + m < len(s) and s[p + m] == s[q + m]:
                    m += 1
                expected_common.append(m)
            expected_order += [p + first[t] for p in by]
            places = {}
            for a in range(len(s)):
                for b in range(a + 2, len(s) + 1):
                    places.setdefault(tuple(s[a:b]), []).append(a)
            for w, at in places.items():
                after = {s[p + len(w)] if p + len(w) < len(s) else ("end", p) for p in at}
                before = {s[p - 1] if p else ("begin", p) for p in at}
                if len(at) > 1 and len(after) > 1 and len(before) > 1:
                    expected.append((w, len(at)))
        assert list(order) == expected_order and list(common) == expected_common
        found = repetition.maximal_repeats(ids, first, order, common, 2)
        got = [(tuple(ids[order[x] : order[x] + m]), y - x) for m, x, y in zip(found.length, found.left, found.right)]
        assert sorted(got) == sorted(expected)


def test_long_common_prefixes_are_followed_to_their_end():
    base = np.arange(5000)
    ids = np.concatenate([base, [6000], base, [6001], base[:3000]])
    numbers = repetition.measure(ids, np.array([0, len(ids)]), 20)
    assert numbers["longest_repeat"][0] == 5000 and numbers["n_covered"][0] == 13000 and numbers["n_maximal"][0] == 2


def repeated(own, size):
    counts = Counter(tuple(own[p : p + size]) for p in range(len(own) - size + 1))
    return {p + k for p in range(len(own) - size + 1) if counts[tuple(own[p : p + size])] > 1 for k in range(size)}


def plain_rules(doc_id, text):
    own, text = words(text), text or ""
    lines = [x for x in text.split("\n") if words(x)]
    base = len(own) < 50 or 100 * len(repeated(own, 3)) > 50 * len(own)
    kept = not base and 100 * len(repeated(own, repetition.LEAST_REPEAT)) <= repetition.MOST_COVERED * len(own)
    kept = kept and not repeated(own, repetition.LONGEST_REPEAT + 1)
    return (
        doc_id, len(own), sum(map(len, own)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(repeated(own, 3)), base, kept,
    )


def odd_texts():
    rng = random.Random(5)
    prose = [f"w{rng.randrange(3000)}" for _ in range(900)]
    passage = prose[:30]
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one\x1ctwo\xa0three"), (5, "é ü ß " * 20), (6, "a " * 49), (7, "a " * 50),
        (8, "x y\n x y\nx y\n\n\n"), (9, " ".join(prose)), (10, " ".join(prose[:99] + passage + prose[200:300] + passage)),
        (11, " ".join(passage + prose[30:200] + passage)), (12, " ".join(prose[:130] + ["cut"] + prose[:110] + prose[300:900])),
        (13, " ".join(prose[:101] + ["cut"] + prose[:101] + prose[101:900])), (14, " ".join(prose[:100] + ["cut"] + prose[:100] + prose[101:900])),
        (15, "#*$% &|<> " * 3 + " ".join(prose[:60])), (16, "zz " * 4000), (9, " ".join(prose)), (None, "no id"), (None, None),
        (17, "é" * 100_000 + " " + " ".join(prose[:70])), (18, " ".join(prose[:60]) + "\r\n" + " ".join(prose[60:80]) + "\r\n"),
    ]
    return rows


def test_repetition_rules(spark):
    rows = odd_texts()
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    got = tuples(repetition.judge(plain.documents(spark, rows)), *columns)
    expected = [plain_rules(*r) for r in rows]
    assert got == sorted(expected, key=str)
    verdicts = {r[0]: r[-2:] for r in expected}
    assert verdicts[14] == (False, True) and verdicts[13] == (False, False)  # a repeat of 100 words, and of 101
    assert verdicts[9] == (False, True) and verdicts[10] == (False, False) and verdicts[16] == (True, False)
    assert repetition.judge(plain.documents(spark, [])).collect() == []


def plain_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    counts = {}
    for doc_id, text, source in rows:
        text, part = text or "", source or ""
        own = words(text)
        fails = {
            "A": len(own) < 50, "B": 100 * len(set(own)) < 65 * len(own), "D": bool(re.search("[#$%&*|]", text)),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "E": doc_id is not None and any(d is not None and d < doc_id and (x or "") == text for d, x, _ in rows),
        }
        counts.setdefault(part, []).append((doc_id, {k for k, v in fails.items() if v}))
    out = []
    for part, own in counts.items():
        at = len(out)
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                gone, now = set(order[: step - 1]), set(order[:step])
                removed = [d for d, f in own if letter in f and not f & gone]
                total[letter] += len(removed)
                out.append([
                    part, order, step, sum(not f & now for _, f in own), len(removed), sum(letter in f and bool(f & gone) for _, f in own),
                    sum(f == {letter} for _, f in own), sum(d in good for d in removed), sum(d in toxic for d in removed),
                ])
        for r in out[at:]:
            r.append(total[r[1][r[2] - 1]])
    return sorted(map(tuple, out))


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.mark.parametrize("hot", [False, True])
def test_filter_audit(spark, hot):
    rng = random.Random(7)
    prose = [" ".join(f"w{rng.randrange(500)}" for _ in range(n)) for n in (60, 80, 20, 200)]
    texts = [*prose, prose[0] + " #", "ABC " * 30 + prose[1], "x " * 70, None, "", "é\x1c" * 60, prose[3] + "|" + "Q" * 90]
    rows = [(k, rng.choice(texts), rng.choice(["a", "b", None, "", "c"])) for k in range(80)]
    rows += [(5, rows[5][1], "z"), (5, rows[5][1], rows[5][2]), (6, prose[2], "a"), (None, prose[0], "a"), (None, prose[0], "b"), (None, None, None)]
    if hot:
        rows += [(100 + k, prose[0], "hot") for k in range(600)] + [(None, prose[1], "hot")] * 50
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 90, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(
        [(*r, "x", 1, 2, "y") for r in rows], "doc_id bigint, text string, source string, text_key string, mask int, n int, part string"
    )
    known = spark.createDataFrame([(*r, "p", 0) for r in labels], "doc_id bigint, quality int, toxic int, part string, n int")
    assert sorted(tuple(r) for r in filter_audit.audit(docs.repartition(3), known).select(*AUDIT).collect()) == plain_audit(rows, labels)
    assert filter_audit.audit(docs.limit(0), known).collect() == []


def test_equal_hashes_of_different_texts_are_no_copies(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(filter_audit.F, "xxhash64", lambda *_: F.lit(1).cast("bigint"))
    docs = spark.createDataFrame([(1, "one"), (2, "two"), (3, "one"), (4, "three")], "doc_id bigint, text string")
    assert [r.doc_id for r in filter_audit.copies(docs).collect()] == [3]


def test_grammars_stand_for_their_sequences():
    for group, ids, first in sequences(2, 100):
        g = grammar.build(ids, first)
        assert [g.expand(s) if s >= 0 else [] for s in g.starts()] == group
        assert len(g.names[-1]) == sum(map(bool, group))


def test_extensions_on_grammars():
    rng = random.Random(3)
    for group, ids, first in sequences(3):
        asked = [(t, *sorted(rng.sample(range(len(s) + 1), 2))) for t, s in enumerate(group) if len(s) > 1 for _ in range(20)]
        if not asked:
            continue
        owner, i, j = (np.array(x) for x in zip(*asked))
        g = grammar.build(ids, first)
        on, back = (g.extend(i + first[owner], j + first[owner], owner, forward=d) for d in (True, False))
        for (t, a, b), x, y in zip(asked, on, back):
            s = group[t]
            m = next((k for k in range(len(s) - b) if s[a + k] != s[b + k]), len(s) - b)
            w = next((k for k in range(a) if s[a - 1 - k] != s[b - 1 - k]), a)
            assert (x, y) == (m, w)


def plain_runs(s):
    """(start, length, period) of all runs, by trying every period."""
    found = {}
    for q in range(1, len(s) // 4 + 1):
        i = 0
        while i + q < len(s):
            start = i
            while i + q < len(s) and s[i] == s[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_digests(doc_id, text):
    own = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and own:
        n, g = len(own), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        own = own[:a] + [own[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(own)
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in found)
    kept = " ".join(w for i, w in enumerate(own) if i not in gone)
    milli = None if top[0] is None else 1000 * top[1] // top[2]
    return (doc_id, len(found), *top, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


RUNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_are_those_of_all_periods():
    for group, ids, first in sequences(4):
        found = periodic_runs.find(ids, first)
        for t, s in enumerate(group):
            own = found.owner == t
            assert list(zip(found.start[own], found.length[own], found.period[own])) == plain_runs(s)


def test_periodic_runs(spark):
    rng = random.Random(11)
    tied = "a b a b a b a b x c d c d c d c d"
    rows = [
        (1, None), (2, ""), (3, "\t \n"), (4, "a " * 5), (5, "a " * 6), (6, "a b " * 3), (7, "a b " * 4), (8, tied), (9, "q " * 20_000),
        (10, "a a a a a a b a a a a a a b " * 4), (11, "x\x1cy z\xa0z " * 9), (9, "q " * 30), (9, "q " * 30), (None, "r s t " * 5), (None, None),
        (12, " ".join(f"w{rng.randrange(9)}" for _ in range(3000)) + " again and" * 8),
    ]
    rows += [(k, " ".join(f"w{rng.randrange(200)}" for _ in range(rng.randint(0, 90)))) for k in range(100, 300)]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 10
    got = tuples(periodic_runs.digests(plain.documents(spark, rows)), *RUNS)
    assert got == sorted((plain_digests(*r) for r in rows), key=str)
    assert periodic_runs.digests(plain.documents(spark, [])).collect() == []


def test_runs_of_the_text_itself(spark):
    docs = plain.documents(spark, [(1, "so so so so so so it is"), (2, "nothing here")])
    out = {r.doc_id: r for r in periodic_runs.runs(docs).collect()}
    assert [tuple(r) for r in out[1].runs] == [(0, 6, 1)] and out[1].collapsed == "so it is"
    assert out[2].runs == [] and out[2].collapsed == "nothing here" and out[2].start is None
