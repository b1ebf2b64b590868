"""Operators on documents against plain versions, with NULLs, empty and long texts, ties, repeats and name clashes."""

import hashlib
import os
import random

import pytest

import corpus_pipeline
from brindle.llm import decontamination, exact_dedup, licenses, mixing, ngram_join, queries, token_counts
from brindle.llm.queries import tokenizer_path
from brindle.session import work_folder
from tests.llm import plain

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 5))) + str(rng.randint(0, vocabulary)) for _ in range(n))


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


ODD = [(901, None), (902, ""), (903, "!!! ..."), (904, "é"), (None, "without id " * 3), (None, None)]


def test_contamination(spark):
    items = [(1, prose(1, 40)), (2, prose(2, 5)), (3, "the of the"), (4, None), (5, "..."), (None, prose(3, 20)), (6, prose(2, 5))]
    own = [(k, prose(100 + k, 60)) for k in range(12)]
    first = items[0][1].split()
    own += [
        (20, prose(50, 30) + " " + " ".join(first[5:30]).upper() + ". " + prose(51, 10)),
        (21, " ".join(first[:12])), (22, " ".join(first[:13])), (23, "x " + items[1][1] + " y " + items[1][1]),
        (24, "the of the of the"), (25, prose(52, 3000) + " " + " ".join(first)), (26, " ".join(first[:12] + ["zz"] + first[12:])),
        (20, prose(50, 30) + " " + " ".join(first[5:30]).upper() + ". " + prose(51, 10)), (20, "another text of the same id"),
        (None, " ".join(first)),
    ]
    rows = own + ODD
    docs = plain.documents(spark, rows)
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS item", "2 AS terms")
    got = decontamination.contamination(docs, bench)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert tuples(got, *columns) == sorted(plain.contaminated(rows, items), key=str)
    kept = decontamination.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    wanted = [r for r, c in zip(rows, plain.contaminated(rows, items)) if not c[-1]]
    assert tuples(kept, "doc_id", "text") == sorted(wanted, key=str)


def test_rows_of_one_id_get_their_own_places(spark, monkeypatch):
    items = [(k, prose(500 + k, 30)) for k in range(6)]
    rows = [(i, f"{prose(600 + k, 20)} {t} {t}") for k, t in items for i in (None, 7)] + [(7, prose(700, 50)), (8, items[0][1]), (8, items[0][1])]
    docs, bench = plain.documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")
    seen, plain_join = [], decontamination.with_findings
    monkeypatch.setattr(decontamination, "with_findings", lambda texts, found, *by: seen.append(found) or plain_join(texts, found, *by))
    got = decontamination.contamination(docs, bench)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert tuples(got, *columns) == sorted(plain.contaminated(rows, items), key=str)
    assert seen[0].count() == 13 and seen[0].selectExpr("max(size(places))").first()[0] == 1


def test_contamination_of_nothing(spark):
    docs, bench = plain.documents(spark, [(1, "a b c")]), spark.createDataFrame([], "item_id bigint, text string")
    assert tuples(decontamination.contamination(docs, bench), "doc_id", "n_hit", "contaminated") == [(1, 0, False)]
    assert decontamination.contamination(docs.limit(0), bench).count() == 0


def test_proximity(spark):
    first = prose(1, 13).split()
    docs = plain.documents(spark, [
        (1, " ".join(first)), (2, " ".join(first[:6] + ["in", "between"] + first[6:])), (3, prose(9, 30)),
        (4, " ".join(first[:6] + ["one", "word", "too", "many"] + first[6:])), (5, " ".join(first[6:] + first[:6])),
    ])
    bench = spark.createDataFrame([(7, " ".join(first))], "item_id bigint, text string")
    for slop, want in ((0, [(1, 0)]), (2, [(1, 0), (2, 2)]), (4, [(1, 0), (2, 2), (4, 4)])):
        assert tuples(decontamination.proximity(docs, bench, slop=slop), "doc_id", "apart") == want


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_proximity_equals_brute_force(spark, slop):
    rng = random.Random(slop)
    few = "ab cd ef gh ij".split()  # few words, so that terms repeat inside windows
    items = [(k, " ".join(rng.choices(few, k=rng.choice([1, 2, 4, 5, 9])))) for k in range(12)]
    items += [(3, "ab ab cd ab"), (None, "ab cd"), (40, None), (41, "...")]
    rows = [(k, " ".join(rng.choices([*few, "zz"], k=rng.choice([0, 1, 6, 40])))) for k in range(40)]
    for k, (_, text) in enumerate(items[:12]):  # items with words put in, at the begin and at the end of a text
        own = text.split()
        for _ in range(2):
            own.insert(rng.randrange(len(own) + 1), "qq")
        rows += [(100 + k, " ".join(own)), (200 + k, prose(k, 30) + " " + " ".join(own))]
    rows += [(300, None), (301, ""), (5, items[5][1]), (None, items[6][1]), (None, items[6][1]), *ODD]
    rows.append((302, " ".join([prose(5, 3000), items[4][1], prose(6, 3000)])))
    got = decontamination.proximity(plain.documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"), 5, slop)
    want = {(*key, apart) for key, apart in plain.near(rows, items, 5, slop).items()}
    assert any(w[-1] == slop for w in want)
    assert tuples(got, "doc_id", "item_id", "start", "apart") == sorted(want, key=str)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.proximity(plain.documents(spark, rows[:2]), none).count() == 0


def test_proximity_query_on_the_tables(spark):
    """Every phrase that op1 finds is a match with nothing in between."""
    folder = "/root/testdata/sf0.001"
    near = queries.QUERIES["benchmark_proximity"](spark, folder).where("least_apart = 0")
    exact = queries.QUERIES["op1_decontamination"](spark, folder)
    found = {r.doc_id: r.n_items for r in exact.where("n_items > 0").collect()}
    assert found and {r.doc_id: r["count"] for r in near.groupBy("doc_id").count().collect()} == found


def test_exact_duplicates(spark):
    rows = [(k, f"Text {k % 7}" if k % 2 else f"tEXT {k % 7}") for k in range(40)] + [(100, "É"), (101, "é"), (5, "text 5"), (5, "text 5")]
    rows += ODD
    docs = plain.documents(spark, rows)
    for counters in (2, 4096):  # with and without digests that are shuffled
        got = exact_dedup.decide(docs, counters)
        groups = {}
        for d, t in rows:
            groups.setdefault((t or "").translate(plain.LOWER), []).append(d)
        best = {t: max(ids, key=lambda d: (d is not None, d or 0)) for t, ids in groups.items()}
        want = [
            (d, best[n], len(groups[n]), hashlib.sha256(n.encode()).hexdigest())
            for d, n in ((d, (t or "").translate(plain.LOWER)) for d, t in rows)
        ]
        assert tuples(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=str)
        stays = got.where("kept")
        assert stays.where("NOT doc_id <=> keep_id").count() == 0
        assert tuples(stays, "text_sha256") == sorted((hashlib.sha256(t.encode()).hexdigest(),) for t in groups)
        kept = exact_dedup.keep_one(docs, counters)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id, (r.text or "").translate(plain.LOWER)) for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(
            (d, t) for t, d in best.items() if d is not None
        )
    assert exact_dedup.decide(docs.limit(0)).count() == 0


def test_misra_gries_keeps_what_is_frequent(spark):
    rows = [(k, "hot" if k % 3 == 0 else f"cold {k}") for k in range(3000)]
    narrow = exact_dedup._narrow(plain.documents(spark, rows).repartition(5))
    few = [r[0] for r in exact_dedup.frequent(narrow, 50).collect()]
    assert hashlib.sha256(b"hot").digest() in [bytes(x) for x in few] and len(few) <= 51


def near(seed, n, changes):
    own = prose(seed, n).split()
    rng = random.Random(seed + changes)
    for k in rng.sample(range(n), changes):
        own[k] = f"changed{seed}x{k}"
    return " ".join(own)


def test_similar_texts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)  # so that groups are cut into blocks
    rows = [(k, prose(1000 + k, 30 + k)) for k in range(20)]
    rows += [(100 + k, near(1, 200, k % 4)) for k in range(30)] + [(200 + k, near(2, 60, k)) for k in range(4)]
    rows += [(300, "a b c"), (301, "A, b: c!"), (302, "a b d"), (303, "a b c d e f"), (304, "a b c d e"), (305, prose(5, 9000)), (306, prose(5, 9000) + " end")]
    rows += [(901, None), (902, ""), (903, "!!!")]
    docs = plain.documents(spark, rows)
    got = ngram_join.similar(docs)
    assert tuples(got, "doc_id", "class_id", "class_size", "n_links", "group_id") == sorted(plain.similar(rows), key=str)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({g for *_, g in plain.similar(rows)})


def test_similar_repeats_and_nothing(spark):
    same = prose(7, 30)
    docs = plain.documents(spark, [(3, same), (3, same), (None, same), (4, same + " x"), (5, prose(8, 40)), (None, None)])
    got = sorted((tuple(r) for r in ngram_join.similar(docs).collect()), key=str)
    assert got == sorted([(3, 3, 3, 1, 3), (3, 3, 3, 1, 3), (None, 3, 3, 1, 3), (4, 4, 1, 1, 3), (5, 5, 1, 0, 5), (None, None, 1, 0, None)], key=str)
    assert tuples(ngram_join.keep_one(docs), "doc_id") == sorted([(3,), (5,), (None,)], key=str)
    assert ngram_join.similar(docs.limit(0)).count() == 0


def test_forest_shortens_prefixes_until_recall_is_reached():
    assert ngram_join.recall(0.8, 4) >= ngram_join.TARGET > ngram_join.recall(0.8, 5)
    assert ngram_join.recall(0.95, 6) > ngram_join.recall(0.8, 6)


def test_a_large_group_does_not_loosen_the_search_of_others(spark):
    assert ngram_join.forest_depth() == 4 and ngram_join.forest_depth(0.95) == 6
    # The first two share no prefix of six values in any tree, though their coefficient is 41/51.
    rows = [(1, near(1272, 50, 0)), (2, near(1272, 50, 1))] + [(100 + k, near(9, 300, k % 2) + f" end{k}") for k in range(60)]
    got = ngram_join.similar(plain.documents(spark, rows))
    assert tuples(got, "doc_id", "class_id", "class_size", "n_links", "group_id") == sorted(plain.similar(rows), key=str)
    assert {r.doc_id: r.group_id for r in got.collect()}[2] == 1


def test_prefixes_are_shortened_class_by_class(spark):
    copies = [(100 + k, near(9, 300, 0) + f" end{k}") for k in range(40)]  # neighbours at about 0.99
    pair = [(1, near(1272, 50, 0)), (2, near(1272, 50, 1))]  # at 41/51, without a common prefix of six values
    alone = [(50 + k, prose(7000 + k, 80)) for k in range(5)]

    def depths(rows):
        return {r.class_id: r.depth for r in ngram_join.search_depths(plain.documents(spark, rows)).collect()}

    got = depths(copies + pair + alone)
    assert {got[k] for k, _ in copies} == {6} and {got[k] for k, _ in pair} <= {4, 5} and {got[k] for k, _ in alone} == {None}
    assert got == {**depths(copies), **depths(pair), **depths(alone)}  # no group changes how another is searched


TRICKY = [
    None, "", " ", "a", "two words", "  lead", "trail  ", "tab\tand  gaps", "it's we'll", "line\n\nbreak \n x", "x y", "中文 字",
    "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b <|endoftext|>", "sep\x1c here \x1c x", "é" * 500, "word " * 3000, "a  b   c", "🙂 🙂🙂",
]


def test_token_counts(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    rows = list(enumerate(TRICKY)) + [(None, "no id"), (3, "a"), (3, "a")]
    got = token_counts.token_counts(plain.documents(spark, rows), tokenizer_path(), limit=10, batch=50)
    want = [(d, len((t or "").encode()), n := len(whole.encode(t or "", add_special_tokens=False).ids), n > 10) for d, t in rows]
    assert tuples(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=str)
    assert got.limit(0).count() == 0


def test_parts_give_the_text_back():
    for text in TRICKY:
        assert "".join(token_counts.parts_of(text or "")) == (text or "")


def test_license_scan(spark):
    rows = [
        (1, "x y. Released under the MIT License. z"), (2, "Licensed under the Apache License, Version 2.0.\n" + prose(1, 50)),
        (3, prose(2, 20) + " Licensed under CC BY-NC 4.0. " + prose(3, 2000) + " cc by nc"), (4, "under the mit"), (5, prose(4, 30)),
        (6, "This work is licensed under the GNU General Public License, version 3. " * 2),
        (7, "this work is licensed under a GNU General Public License version 3"), (8, "under the mit license " * 3), (1, "other"),
    ] + ODD
    got = {}
    for r in licenses.scan(plain.documents(spark, rows)).collect():
        got.setdefault((r.doc_id, r.n_words), []).append(r)
    for d, t in rows:
        own, at, labels = plain.words(t), [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            found = [i for i in range(len(own)) if own[i : i + len(p)] == p]
            at += found
            labels |= {label} if found else set()
        r = got[d, len(own)][0]
        assert (r.n_base, r.first_word, r.last_word) == (len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted(labels)) and labels <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
    labels = {d: r.labels for (d, _), (r, *_) in got.items()}
    assert labels[6] == labels[7] == "gpl-3" and labels[4] == labels[5] == "" and labels[2] == "apache-2"
    assert sum(map(len, got.values())) == len(rows)
    assert licenses.scan(plain.documents(spark, [])).count() == 0


def test_closest_spans_equal_all_against_all():
    rng = random.Random(2)
    for n in (0, 1, 5, 60):
        found = [(rng.choice([0.8, 0.9, 0.95, 1.0]), b, b + rng.randint(1, 40), f"l{k}") for k in range(n) for b in [rng.randint(0, 400)]]
        want = [x for x in found if not any(y[0] > x[0] and y[1] < x[2] and x[1] < y[2] for y in found)]
        assert sorted(licenses.closest(found)) == sorted(want)
    many = [(0.8 + k % 3 / 10, 30 * k, 30 * k + 40, "mit") for k in range(100_000)]
    assert 0 < len(licenses.closest(many)) < len(many)  # in a second or so; each against every other takes a quarter of an hour


def test_mixing_meets_targets(spark):
    vocabulary = {"a": "alpha beta gamma delta", "b": "uno dos tres cuatro", "c": "rot blau gelb weiss"}
    rng = random.Random(3)
    rows, domain = [], {}
    for k in range(300):
        d = "aaaaabbc"[k % 8]
        domain[k] = d
        rows.append((k, " ".join(rng.choice(vocabulary[d].split()) for _ in range(rng.randint(5, 60)))))
    rows += [(901, None), (902, ""), (None, "alpha beta"), (None, "alpha beta")]
    docs = plain.documents(spark, rows)
    known = spark.createDataFrame([(k, t, domain[k]) for k, t in rows[:200]] + [(None, "x", "a"), (7, "x", None)], "doc_id bigint, text string, domain string")
    got = mixing.rates(docs, known, {"a": 1, "b": 1, "c": 2}).collect()
    assert len(got) == len(rows)
    total = sum(r.n_tokens for r in got)
    for d, part in (("a", 0.25), ("b", 0.25), ("c", 0.5)):
        have = sum(r.n_tokens * r.rate for r in got if r.domain == d)
        assert have == pytest.approx(part * total, rel=0.01)
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in got)
    assert all(r.domain == domain[r.doc_id] for r in got if r.doc_id in domain)
    assert {r.doc_id: r.n_tokens for r in got}[3] == len(rows[3][1].split())
    drawn = mixing.mixture(docs, known, {"a": 1, "b": 1, "c": 2})
    assert drawn.columns == [*docs.columns, "rate", "copies"] and drawn.where("copies < 1").count() == 0


def test_languages_outside_the_targets_keep_their_part(spark, tmp_path):
    own = {"en": "the quick word", "de": "der alte hund", "fr": "le chat noir", "es": "el perro azul", "it": "gatto nero bello"}
    rows = [(k, own[lang] + " " + own[lang], lang) for k, lang in enumerate([*["en"] * 30, *["de"] * 10, *["fr"] * 10, *["es"] * 10, *["it"] * 20])]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k,) for k, *_ in rows], "doc_id bigint").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.QUERIES["op5_mixing"](spark, str(tmp_path)).collect()
    part = {d: sum(r.rate for r in got if r.domain == d) / len(rows) for d in own}
    assert part == pytest.approx({"it": 0.25, "en": 0.3, "de": 0.15, "fr": 0.15, "es": 0.15}, rel=0.01)
    drawn = corpus_pipeline.mixed(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert drawn.where("lang = 'it'").count() > 0


def test_stages_leave_only_what_their_result_reads(spark):
    rows = [(k, prose(k % 50, 30)) for k in range(60)] + [(70, prose(3, 29)), (71, None), (72, prose(9, 20) + " " + prose(500, 13)), (None, "x y")]
    rows += [rows[4]] * 2
    docs = plain.documents(spark, rows)
    items = spark.createDataFrame([(1, prose(500, 13))], "item_id bigint, text string")
    known = spark.createDataFrame([(k, t, "ab"[k % 2]) for k, t in rows[:40]], "doc_id bigint, text string, domain string")

    def left_by(stage):
        before = set(os.listdir(work_folder(spark)))
        out = stage()
        return out, {p.split("-")[0] for p in set(os.listdir(work_folder(spark))) - before}

    out, left = left_by(lambda: exact_dedup.keep_one(docs))
    assert left == {"best"} and out.count() == len({(t or "") for _, t in rows})
    out, left = left_by(lambda: ngram_join.keep_one(docs))
    assert left == {"lost", "again"} and {r.doc_id for r in out.collect()} >= {0, 49, 71} and out.where("doc_id between 50 and 59").count() == 0
    out, left = left_by(lambda: decontamination.keep_clean(docs, items))
    assert left == {"contaminated"} and out.count() == len(rows) - 1
    out, left = left_by(lambda: mixing.mixture(docs, known, {"a": 1, "b": 1}))
    assert left == {"drawn"} and out.count() > 0


def test_mixing_without_labels_or_rows(spark):
    docs = plain.documents(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id bigint, text string, domain string")
    assert tuples(mixing.rates(docs, none, {"a": 1.0}), "doc_id", "domain", "rate") == [(1, "all", 1.0), (2, "all", 1.0)]
    assert mixing.rates(docs.limit(0), none, {}).count() == 0
    known = spark.createDataFrame([(1, "a b", "a"), (2, "c d", "b")], "doc_id bigint, text string, domain string")
    docs = plain.documents(spark, [(1, "a b a b"), (2, "c d c d")])
    got = {r.doc_id: r.rate for r in mixing.rates(docs, known, {"b": 1.0, "zz": 3.0}).collect()}
    assert 0 <= got[1] < 1 < got[2]
