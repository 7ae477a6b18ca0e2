"""The numbered queries against plain versions, on given tables and on tables of odd rows; odd rows run everywhere."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from mailloom.llm import byte_bpe, centroids, decontamination, licenses, line_crf, queries, ranked, repetition, secrets, seed_extend, simhash, suffix_dedup, url_reputation
from tests.conftest import SF_SMALL
from tests.llm import plain

QUERIES = entry.queries()


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdeéñ") for _ in range(rng.randrange(1, 7))) for _ in range(n))


def odd_tables(folder, empty=False):
    """Nulls in every column, empty and long texts, repeated rows and ids, ties, and extra columns with clashing names."""
    rng = random.Random(3)
    passage, item = _words(rng, 60), _words(rng, 14)
    long = _words(rng, 30_000)
    texts = [None, "", " \n\t ", "a", "one two", "x" * 900, "ab" * 700, passage + " tail", "Head. " + passage, passage, passage, long, long + " end", long[:5000] + "!" + long[5001:]]
    texts += ["\n".join([passage] * 4), f"See {item.upper()}; and {item}", item.rsplit(" ", 1)[0], "Short item", "naïve " * 40, "Licensed under the\nApache  License, Version 2.0!", "mit license mit license", "MİT License KB cc-by; CC BY CC BY"]
    texts += ["This work is licensed under GNU General Public License version 3", "PassWord: 'hunter22' api_key=abc secret token=\"ABCDEF012345\" AKIA" + "Q7" * 8 + " AKIAAKIA", "deadbeef" * 5 + "G" + "0" * 24, "k9Xq2LmZ8vTfR4wYb7NcJd5P", "\x00 nul \x1c\u2028 sep  's 're ''ll \r\n", "𝒳y̆ 漢字 ３４ " * 30, "A! B! C!\n" * 30, "$$$ de,&&& ### |" * 20]
    texts += [_words(rng, rng.randrange(1, 120)) for _ in range(30)]
    texts += [t.replace(" ", "  ", 1) for t in texts[-5:]]
    ids = list(range(len(texts)))
    ids[3], ids[5], ids[6] = None, 4, 4
    docs = list(zip(ids, texts)) + [(7, texts[7]), (None, "a"), (None, None)]
    pages = [(1, "http://A.example.net/en/x?q#f", "<p>1</p>"), (2, "https://net/", "<p>1</p>"), (3, None, None), (4, "nothing", ""), (5, "x://example.com", "é" * 70_000), (None, "http://b.org/fr/1", "<p>1</p>")]
    pages += [(6, "http://example.com/de/\r\nX: y", "same"), (6, "http://sub.example.com/de", "same"), (7, "http://net?x/", "same"), (8, "ftp://u@H:80/://", "\r\n\r\nWARC/1.1\r\n"), (9, "http://notnet/", None)]
    items = [(1, item), (1, item), (2, "Short, item"), (3, None), (4, ""), (None, "short item"), (5, " ".join(item.split()[3:]))]
    labels = [(d, i % 2, None) for i, d in enumerate(ids)] + [(7, None, 1), (None, 1, 0), (7, 0, 0)]
    k = 0 if empty else None
    bad = lambda n: pa.array([None] * n, pa.string())

    def write(name, rows, fields, **more):
        rows = rows[:k]
        columns = {f: pa.array([r[i] for r in rows], t) for i, (f, t) in enumerate(fields)}
        columns |= {c: bad(len(rows)) for c in more.get("extra", ())}
        pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")

    i8, s, i4 = pa.int64(), pa.string(), pa.int32()
    clash = ("h", "d1", "fp", "spans", "words", "host", "bad", "shard", "held_out", "score", "first", "row")
    write("documents", [(d, t, None, None, None) for d, t in docs], (("doc_id", i8), ("text", s), ("lang", s), ("source", s), ("n_chars", i8)), extra=clash)
    write("pages", pages, (("page_id", i8), ("url", s), ("html", s)), extra=("path", "rule", "low", "digest", "size", "domain", "n"))
    write("benchmark", items, (("item_id", i8), ("text", s)), extra=("words",))
    write("labels", labels, (("doc_id", i8), ("quality", i4), ("toxic", i4)), extra=("text", "bad"))
    near = [rng.gauss(0, 1) for _ in range(64)]
    vectors = [(i, [x + rng.gauss(0, 0.05 * (i % 7)) for x in near]) for i in range(60)] + [(i, [rng.choice((-1.0, 0.0, 0.5)) for _ in range(64)]) for i in range(60, 120)]
    vectors += [(3, near), (3, near), (None, near), (None, [0.0] * 64), (200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] + [1.0] * 63)]
    vectors += [(205, [float("nan")] + [1.0] * 63), (206, [float("-inf")] + [1.0] * 63), (207, [3e38, -3e38] * 32), (208, [-0.0] * 64)]
    write("embeddings", [(*v, None) for v in vectors], (("vec_id", i8), ("embedding", pa.list_(pa.float32())), ("label", i4)), extra=("vector", "cluster", "totals", "pos"))
    return ([] if empty else docs), ([] if empty else pages), ([] if empty else items)


def _read(folder):
    get = lambda n, *c: list(zip(*(pq.read_table(f"{folder}/{n}.parquet", columns=list(c)).column(x).to_pylist() for x in c)))
    return get("documents", "doc_id", "text"), get("pages", "page_id", "url", "html"), get("benchmark", "item_id", "text")


@pytest.fixture(scope="module", params=["given", "odd", "empty"])
def tables(request, tmp_path_factory):
    if request.param == "given":
        return SF_SMALL, *_read(SF_SMALL)
    folder = str(tmp_path_factory.mktemp(request.param))
    return folder, *odd_tables(folder, request.param == "empty")


def rows(spark, folder, name, *columns):
    (query,) = (k for k in QUERIES if k.startswith(name + "_"))
    df = QUERIES[query](spark, folder)
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def same(got, want):
    assert got == sorted(want, key=repr)


def test_op1(spark, tables):
    same(rows(spark, tables[0], "op1"), plain.op1(tables[1]))


def test_op2(spark, tables):
    same(rows(spark, tables[0], "op2"), plain.op2(tables[2]))


def test_op3(spark, tables):
    same(rows(spark, tables[0], "op3", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), plain.op3(tables[1]))


def test_op3_verdicts(spark, tables):
    limits = repetition.MOST_COVERED, repetition.MOST_LONGEST, repetition.REPEAT_WORDS
    short = {r[0]: r[-1] for r in plain.op3(tables[1]) if r[0] is not None and r[1] <= 1500}
    got = {r[0]: r[1] for r in rows(spark, tables[0], "op3", "doc_id", "kept") if r[0] in short}
    texts = dict(tables[1])
    ids = [d for d, _ in tables[1]]
    once = [d for d in short if ids.count(d) == 1]
    assert {d: got[d] for d in once} == {d: plain.op3_kept(texts[d], short[d], *limits) for d in once}


def test_benchmark_in_blocks(spark, monkeypatch):
    """Blocks of few words, no vocabulary, items longer than a block: hits of all blocks make one row."""
    rng = random.Random(12)
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 30)
    monkeypatch.setattr(decontamination, "VOCABULARY", 50)
    items = [(i, _words(rng, rng.choice((3, 12, 25)))) for i in range(8)] + [(9, _words(rng, 70)), (None, _words(rng, 11))]
    docs = [(i, " ".join([_words(rng, 4), *(rng.choice(items)[1] for _ in range(3)), _words(rng, 3)])) for i in range(30)] + [(30, items[8][1][40:]), (4, "clean"), (None, None)]
    found = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), plain.sha(",".join(sorted(map(str, r["items"]))).encode()), r["n_hit"] > 0) for r in found.collect()]
    same(sorted(got, key=repr), plain.op5(docs, items))


def test_words_whose_polynomial_hashes_agree(spark, tmp_path):
    """A word of two letters in the order of Thue and Morse, and its complement: no phrase of the one is in the other."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    docs, items = [(1, f"x {one} y"), (2, f"x {two} y")], [(7, f"x {one}"), (None, f"{two} y")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    same(rows(spark, str(tmp_path), "op5"), plain.op5(docs, items))


def test_op4(spark, tables):
    same(rows(spark, tables[0], "op4"), plain.op4(tables[1], licenses.PHRASES, licenses.TEMPLATES, licenses.THRESHOLD))


def test_notices_across_lines(spark, tmp_path):
    templates = dict(licenses.TEMPLATES)
    wrap = lambda text, n: "\n".join(" ".join(text.split()[i : i + n]) for i in range(0, len(text.split()), n))
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the"
    filler = " ".join(f"w{i}" for i in range(15))
    docs = [(1, f"{filler}\n{grant} \"Software\")"), (2, f"{filler} {wrap(templates['mit-text'], 11)} {filler}"), (3, wrap(templates["isc-text"], 7).title())]
    docs += [(4, f"copyright {filler} all {filler} rights {filler} reserved"), (5, "Copyright 2020 by X.\nAll rights\nreserved.")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r[0]: r for r in rows(spark, str(tmp_path), "op4")}
    labels = {d: set(r[6].split(",")) for d, r in found.items()}
    assert labels[1] == {"mit-grant"} and {"mit-grant", "mit-text"} <= labels[2] and "isc-text" in labels[3]
    assert labels[4] == {""} and labels[5] == {"rights-reserved"}
    same(list(found.values()), plain.op4(docs, licenses.PHRASES, licenses.TEMPLATES, licenses.THRESHOLD))


def test_op5(spark, tables):
    same(rows(spark, tables[0], "op5"), plain.op5(tables[1], tables[3]))


def test_op6(spark, tables):
    same(rows(spark, tables[0], "op6"), plain.op6(tables[1]))


def test_op7(spark, tables):
    got = rows(spark, tables[0], "op7", "doc_id", "held_out", "predicted", "score")
    assert sorted((r[0] is None, r[0] or 0, r[1]) for r in got) == sorted((d is None, d or 0, plain.held_out(d)) for d, _ in tables[1])
    assert all(0 <= r[3] <= 1 and r[2] == (r[3] >= 0.3) for r in got)


def test_op8(spark, tables):
    same(rows(spark, tables[0], "op8", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256"), plain.op8(tables[1]))


def test_op9(spark, tables):
    import base64
    import struct

    import public_tokenizers
    import tiktoken

    with open(queries.tokenizer(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t in tables[1]:
        ids = known.encode_ordinary(t or "")
        want.append((d, len(ids), plain.sha(struct.pack(f"<{len(ids)}I", *ids)), plain.sha((t or "").encode())))
    same(rows(spark, tables[0], "op9"), want)


def test_op10(spark, tables):
    got = rows(spark, tables[0], "op10", "page_id", "host", "path", "rule", "verdict")
    labels = pq.read_table(f"{tables[0]}/labels.parquet", columns=["doc_id", "quality"]).to_pylist()
    outcomes = [(r["doc_id"], None if r["quality"] is None else 1 - r["quality"]) for r in labels]
    u = url_reputation
    same(got, plain.op10_verdicts(tables[2], outcomes, u.RULES, u.BOUND, u.THRESHOLD, u.WEAKEST, u.STRONGEST))


def test_op11(spark, tables):
    vectors = pq.read_table(f"{tables[0]}/embeddings.parquet", columns=["vec_id", "embedding"]).to_pylist()
    same(rows(spark, tables[0], "op11", "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), plain.op11([tuple(v.values()) for v in vectors]))


def test_op12(spark, tables):
    same(rows(spark, tables[0], "op12", "item_id", "rank", "doc_id", "score"), plain.op12(tables[1], tables[3]))


def test_op13(spark, tables):
    same(rows(spark, tables[0], "op13", "doc_id", "n_words", "n_removed", "kept_sha256"), plain.op13(tables[1]))


def test_pipeline(spark, tables):
    """Each stage on what the one before it kept, against plain versions."""
    import corpus_pipeline

    folder, docs, _, items = tables
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    plain_rows = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        kept = plain_rows(frame)
        after = corpus_pipeline.stored(stage(spark, frame, folder), "test-" + name)
        if name == "quality":
            assert set(plain_rows(after)) <= set(kept)
        elif name == "near_duplicates":
            got, want = plain_rows(after), plain.first_of_groups(kept)
            assert len(got) == len(want) and all(any(g in group for g in got) for group in want)
        elif name == "decontaminate":
            hit = {i for i, r in enumerate(plain.op5(kept, items)) if r[-1]}
            same(plain_rows(after), [r for i, r in enumerate(kept) if i not in hit])
        elif name == "secrets":
            assert sorted((d is None, d or 0) for d, _ in plain_rows(after)) == sorted((d is None, d or 0) for d, _ in kept)
            assert all(secrets.spans_of(t or "") == [] for _, t in plain_rows(after))
        else:
            same([(r["doc_id"], r["decoded_sha256"]) for r in after.collect()], [(d, plain.sha((t or "").encode())) for d, t in kept])
        assert name == "encode" or after.columns == frame.columns
        frame = after


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    scored = [r for r in QUERIES["op7_line_crf"](spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in scored) >= 0.97 * len(scored)


def test_an_anchor_with_many_extents(spark, tmp_path, monkeypatch):
    """Groups and blocks so small that one anchor is dealt to many: strings still meet."""
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 800)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 2000)
    rng = random.Random(5)
    core = _words(rng, 30)
    docs = [(i, _words(rng, 12) + " " + core + " " + _words(rng, rng.choice([3, 12]))) for i in range(60)]
    docs += [(100 + i, t[rng.randrange(40) :]) for i, (_, t) in enumerate(docs[:25])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = suffix_dedup.deduplicate(df).selectExpr("doc_id", "n_bytes", "n_removed", "size(removed) n", "kept_sha256").collect()
    same(sorted((tuple(r) for r in got), key=repr), plain.op1(docs))


def test_by_words_settles_ties_by_later_words():
    import numpy as np

    rng = np.random.default_rng(8)
    raw = bytes(rng.integers(0, 2, 900).astype(np.uint8)) + b"\1" * 300 + bytes(40)
    at = rng.permutation(1200)
    got = suffix_dedup.by_words(np.frombuffer(raw, np.uint8), at, 28).tolist()
    assert sorted(got) == list(range(1200)) and [raw[p : p + 28] for p in got] == sorted(raw[p : p + 28] for p in at)


def test_two_stage_order():
    import numpy as np

    rng = np.random.default_rng(1)
    for letters in (1, 2, 3, 200):
        parts = [bytes(rng.integers(0, letters, rng.integers(20, 60)).astype(np.uint8)) for _ in range(40)]
        data = np.frombuffer(b"\0".join(parts) + bytes(28) + b"\1" + bytes(8), np.uint8)
        first = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
        last = first + np.array([len(p) for p in parts]) - 20
        raw = data.tobytes()
        got = suffix_dedup.two_stage(data, first, last, 20)
        wanted = [p for a, b in zip(first, last) for p in range(a, b + 1)]
        assert sorted(got.tolist()) == wanted
        keys = [raw[p : p + 20] for p in got.tolist()]
        assert keys == sorted(keys)


def test_many_links_in_one_shard(spark):
    """A ball of fingerprints beyond a tree's size is dealt again and loses no link."""
    rng = random.Random(2)
    center = rng.getrandbits(64)
    fps = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 7))) for _ in range(500)}
    fps |= {rng.getrandbits(64) for _ in range(200)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    got = {r["node"] & (1 << 64) - 1: r["root"] for r in simhash.components(simhash.links(df, 3, 16)).collect()}
    parent = {f: f for f in fps}

    def top(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 3:
                parent[top(a)] = top(b)
    want = {}
    for f in fps:
        want.setdefault(top(f), set()).add(f)
    have = {}
    for f, r in got.items():
        have.setdefault(r, set()).add(f)
    assert sorted(map(sorted, have.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_proximity():
    import numpy as np

    lists = {1: np.array([5, 50, 90]), 2: np.array([7, 51]), 3: np.array([7, 52, 93])}
    assert decontamination.find(lists, [1, 2, 3]).tolist() == [50]
    assert decontamination.find(lists, [1, 2, 3], 1).tolist() == [6, 50]
    assert decontamination.find(lists, [1, 4]).tolist() == []


def test_maximal_repeats():
    """Against all substrings: those found twice or more whose places agree neither before nor after them."""
    import numpy as np

    rng = random.Random(31)
    cases = [[[1, 2, 3, 1, 2, 3, 1, 9, 8, 8, 8]], [[5] * 9], [[1, 2] * 6, [3]], [[7]], [[1, 2, 3, 4], [5, 6, 5, 6, 5]]]
    cases += [[[100 * t + rng.randint(1, 3) for _ in range(rng.randint(1, 25))] for t in range(3)] for _ in range(40)]
    for texts in cases:
        symbols = np.array([s for t in texts for s in t], np.uint64)
        ends = np.cumsum([len(t) for t in texts])
        begins = np.isin(np.arange(len(symbols)), ends - [len(t) for t in texts])
        levels = repetition.suffix_ranks(symbols, np.repeat(ends, [len(t) for t in texts]))
        for least in (1, 2, 4):
            want, reach = [], [0] * len(symbols)
            for text, end in zip(texts, ends.tolist()):
                for n in range(least, len(text)):
                    places = {}
                    for i in range(len(text) - n + 1):
                        places.setdefault(tuple(text[i : i + n]), []).append(i)
                    for word, at in places.items():
                        left = {text[i - 1] if i else -1 - i for i in at}
                        right = {text[i + n] if i + n < len(text) else -1 for i in at}
                        if len(at) > 1 and (len(left) > 1 or 0 in at) and len(right) > 1:
                            want.append((n, word))
                            for i in at:
                                reach[end - len(text) + i] = n
            lengths, first, got = repetition.maximal_repeats(symbols, begins, levels, least)
            assert sorted((n, tuple(symbols[i : i + n].tolist())) for n, i in zip(lengths.tolist(), first.tolist())) == sorted(want)
            assert got.tolist() == reach


def test_proximity_marks_the_words(spark):
    """A place that strays is found with a slop, across no document, and what is marked stays inside the document."""
    item = [f"w{i}" for i in range(12)]
    swapped, apart = item[:4] + [item[5], item[4]] + item[6:10], item[:5] + ["x", "x"] + item[5:10]
    docs = [(1, " ".join(item)), (2, " ".join(["a", *swapped, "b"])), (3, " ".join(apart)), (4, " ".join(item[:5])), (5, " ".join(item[5:])), (6, "")]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    found = {}
    for slop in (0, 1, 2):
        rows_ = decontamination.contaminated(docs, items, slop=slop).collect()
        found[slop] = {r["doc_id"]: [tuple(h) for h in r["hits"]] for r in rows_ if r["n_hit"]}
        assert all(r["n_hit"] == sum(b - a for a, b in r["hits"]) and 0 <= r["n_hit"] <= r["n_words"] for r in rows_)
    assert found[0] == {1: [(0, 12)]}
    assert found[1].keys() == {1, 2} and found[1][1] == [(0, 12)] and any(a <= 1 and b >= 11 for a, b in found[1][2])
    assert found[2].keys() == {1, 2, 3}


def test_entropy_spans_and_allow_list():
    key = "k9Xq2LmZ8vTfR4wYb7NcJd5P"
    assert secrets.entropy_spans(f"see {key}.") == [(4, 4 + len(key))]
    for harmless in ("123e4567-e89b-12d3-a456-426614174000", "theaeresandonthatinging", "2024-01-01-2024-01-02-2024", "sha256-k9Xq2LmZ8vTfR4wYb7NcJd5Pk9Xq"):
        assert secrets.entropy_spans(harmless) == []


def test_marginals_sum_over_all_labelings():
    import itertools
    import math

    own, t = [0.4, -1.0, 2.0], (0.7, -0.3, 0.1, 0.9)
    table = [[t[0], t[1]], [t[2], t[3]]]
    weight = {y: math.exp(sum(u * k for u, k in zip(own, y)) + sum(table[a][b] for a, b in zip(y, y[1:]))) for y in itertools.product((0, 1), repeat=3)}
    total = sum(weight.values())
    want = [sum(w for y, w in weight.items() if y[i]) / total for i in range(3)]
    assert line_crf._marginals(own, t).tolist() == pytest.approx(want)


def test_slices_and_decoding():
    v = byte_bpe.vocabulary(queries.tokenizer())
    ((ids, starts),) = v.encode(["We're  here\n\n 12x"])
    assert [int(s) for s in starts] == [0, 2, 5, 6, 11, 13, 16]
    assert v.decode(ids) == "We're  here\n\n 12x".encode()


def test_entropy_of_keys_without_digits():
    rng = random.Random(5)
    assert secrets.entropy_spans("see kQxTzLmWvRfBwYbGNcJdHPaEsu.") == [(4, 30)]
    keys = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", k=40)) for _ in range(200)]
    assert sum(secrets.entropy_spans(f"see {k}.") != [] for k in keys) >= 190
    for word in ("internationalization", "DocumentObjectModelElement", "getElementsByClassNameOnce", "WWWWWWWWWWWWaaaaaaaaaaaaaaa", "ANTIDISESTABLISHMENTARIANISM"):
        assert secrets.entropy_spans(word) == []


def test_spans_by_a_plain_recount():
    """Every window of every class, its entropy counted anew."""
    import math

    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=- "
    for _ in range(300):
        text = "".join(rng.choices(letters[: rng.choice((16, 36, 52, 62, 68))], k=rng.randrange(10, 90)))
        want = set()
        for m in secrets.CANDIDATE.finditer(text):
            if any(a.fullmatch(m.group()) for a in secrets.ALLOWED):
                continue
            for c in secrets.CHARSETS:
                for part in c.form.finditer(m.group()):
                    p = part.group()
                    if not all(x.search(p) for x in c.mixes):
                        continue
                    for i in range(len(p) - c.window + 1):
                        w = p[i : i + c.window]
                        if -sum(w.count(x) / len(w) * math.log2(w.count(x) / len(w)) for x in set(w)) >= c.bits - 1e-9:
                            want.update(range(m.start() + part.start() + i, m.start() + part.start() + i + c.window))
        assert {i for a, b in secrets.entropy_spans(text) for i in range(a, b)} == want


def test_entropy_of_keys_in_one_letter_case():
    rng = random.Random(4)
    for letters in ("abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
        keys = ["".join(rng.choices(letters, k=32)) for _ in range(200)]
        assert sum(secrets.entropy_spans(f"see {k}.") == [(4, 36)] for k in keys if any(c.isdigit() for c in k)) >= 190
        assert secrets.entropy_spans("md5-" + keys[0] + keys[1]) != []
    assert secrets.entropy_spans("sha256-" + "0123456789abcdef" * 4) == secrets.entropy_spans("internationalization20") == []


def test_hosts_without_outcomes_have_the_level_above(spark):
    pages = [(i, f"http://h{i % 20}.{('bad', 'good')[i % 2]}.org/") for i in range(400)]
    outcomes = [(i, 1 - i % 2) for i in range(400)]
    pages += [(500, "http://new.bad.org/"), (501, "http://new.good.org/"), (502, "http://other.net/"), (503, None)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    known = spark.createDataFrame(outcomes, "page_id long, bad long")
    found = {r["page_id"]: r["verdict"] for r in url_reputation.judge(df, known, rules=()).where("page_id >= 500").collect()}
    assert found == {500: "block", 501: "allow", 502: "allow", 503: "allow"}
    means = {r["host"]: (r["n"], r["mean"]) for r in url_reputation.reputation(df, known).collect()}
    assert means[""] == means["other.net"] == (0, pytest.approx(201 / 402))


def test_pipeline_decontaminates_each_text_by_itself(spark, tmp_path):
    import corpus_pipeline

    item, other = "one two three four five six seven eight nine ten eleven", "a b c d e f g h i j k l"
    spark.createDataFrame([(1, item), (None, other)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, "so " + item), (1, "clean one"), (None, item), (None, "clean two"), (None, None), (2, other), (3, "clean three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(sorted((tuple(r) for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()), key=repr), [rows[i] for i in (1, 3, 4, 6)])


def test_nearest_skips_centroids_and_keeps_ties():
    import numpy as np

    rng = np.random.default_rng(3)
    centers = np.concatenate([rng.integers(-60, 60, (14, 64)) + 40 * np.arange(14)[:, None], np.zeros((2, 64), np.int64)])
    points = np.concatenate([centers[rng.integers(0, 16, 3000)] + rng.integers(-9, 9, (3000, 64)), np.zeros((5, 64), np.int64), centers + (1 << 27)])
    nearest = centroids.Nearest(centers)
    number, distance = nearest(points)
    apart = ((points[:, None] - centers[None]) ** 2).sum(2)
    assert (distance == apart.min(1)).all() and (number == apart.argmin(1)).all()
    assert nearest.compared < 0.5 * apart.size


def test_nra_stops_early_and_resolves_ties():
    import numpy as np

    rng = np.random.default_rng(4)
    for trial in range(60):
        n, k = int(rng.integers(1, 3000)), int(rng.integers(1, 6))
        docs = rng.permutation(n).astype(np.int64) // 2
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(k):
            places = rng.permutation(n)[: rng.integers(0, n + 1)]
            impacts = np.sort(rng.integers(1, (5, 10**6)[trial % 2], len(places)))[::-1]
            lists.append((places, impacts))
            total[places] += impacts
        best = int(rng.integers(1, 60))
        want = sorted((-s, d) for s, d in zip(total.tolist(), docs.tolist()) if s > 0)[:best]
        places, scores = ranked.nra(lists, docs, best)
        assert [(-s, d) for s, d in zip(scores.tolist(), docs[places].tolist())] == want
        bar = -want[len(want) // 2][0] if want else 0
        places, scores = ranked.nra(lists, docs, best, bar)
        assert [(-s, d) for s, d in zip(scores.tolist(), docs[places].tolist()) if s > bar] == [w for w in want if -w[0] > bar]


def test_terms_of_a_long_text():
    text = ("Ab, cd-" * 9 + "x" * 50 + " é1 ") * 40
    whole = ranked.count_terms(text.encode())
    old, ranked.PIECE = ranked.PIECE, 37
    try:
        assert ranked.count_terms(text.encode()) == whole
    finally:
        ranked.PIECE = old
    assert whole[b"ab"] == 360 and whole["é1".encode()] == 40


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_BYTES", 300)
    monkeypatch.setattr(ranked, "SLAB", 4000)
    docs, _, items = _read(SF_SMALL)
    same(rows(spark, SF_SMALL, "op12", "item_id", "rank", "doc_id", "score"), plain.op12(docs, items))


def test_seeds_cut_by_ranges_and_pieces(spark, monkeypatch):
    """Many ranges and short pieces: runs that a range's edge cuts, one passage in most texts, near copies."""
    monkeypatch.setattr(seed_extend, "PIECE_WORDS", 40)
    rng = random.Random(6)
    passage, words = _words(rng, 30), _words(rng, 90).split()
    docs = []
    for i in range(300):
        near = list(words)
        near[rng.randrange(90)] = "changed"
        docs.append((rng.randrange(250), rng.choice([f"{_words(rng, 9)} {passage} {_words(rng, 9)}", " ".join(near), passage, " ".join(words), f"{passage} {passage} {passage}"])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(plain.op13(docs), key=repr)
    for partitions, most in (("3", 100_000), ("60", 2)):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        monkeypatch.setattr(seed_extend.meet, "__defaults__", (most,))
        try:
            found = seed_extend.deduplicate(df)
            same(sorted((tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr), want)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_suffix_blocks_are_slim():
    """a block of op1 takes about 26 bytes a byte of its extents, 71 before, and hands its strings on in batches."""
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 123, 300).astype(np.uint8).tobytes() for _ in range(3_500)]
    texts += texts[:10]
    n = len(texts)
    ones, number = [1] * n, list(range(n))
    columns = [pa.array(ones), pa.array(ones), pa.array([False] * n), pa.array([True] * n), pa.array(number), pa.array(number), pa.array([0] * n), pa.array(texts, pa.binary())]

    class Frame:
        repartition = sortWithinPartitions = select = lambda self, *_: self
        mapInArrow = lambda self, task, _: task

    task = suffix_dedup.suffix_repeats(Frame())
    batch = pa.RecordBatch.from_arrays(columns, names=list("abcdefgh"))
    tracemalloc.start()
    found = [(b.num_rows, b.filter(pa.array([k == "span" for k in b.column(0).to_pylist()])).num_rows) for b in task(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * sum(map(len, texts)) and max(rows for rows, _ in found) <= 1 << 15
    # Each string once, but for the repeated texts' second copies; both copies are spans.
    assert sum(spans for _, spans in found) == 20 and sum(rows - spans for rows, spans in found) == 101 * 3_500


@pytest.mark.parametrize("size", [1 << 18, 1000, 7])
def test_members_beyond_a_piece_end(size):
    """a record that unpacks to more than a piece ends; the reader turned on its last block for ever."""
    import io
    import itertools
    import zlib

    from mailloom.llm import warc

    records = [b"a" * 700_000, b"", random.Random(3).randbytes(3_000), b"b" * 300_000, b"c"] if size > 7 else [b"a" * 700, b"", b"xyz" * 20, b"c"]
    packed = b"".join(z.compress(r) + z.flush() for r in records for z in [zlib.compressobj(1, zlib.DEFLATED, 31)])
    pieces = list(itertools.islice(warc._bytes(io.BytesIO(packed), size), 20_000))
    assert b"".join(pieces) == b"".join(records) and max(map(len, pieces)) <= size


def test_pages_beyond_a_piece_are_archived(spark):
    """op2 ends on pages of more than 256 KB among small ones."""
    from mailloom.llm import warc

    pages = [(i, f"http://h/{i}", ("<p>%d</p>" % i) * (60_000 if i % 3 == 0 else 3)) for i in range(9)]
    got = {r["page_id"]: r["payload_bytes"] for r in warc.archive(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {i: len(html) for i, _, html in pages}
