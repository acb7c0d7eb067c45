"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from strataflow.llm import (
    chat_format, language_id, lattice_dedup, lattice_lm, license_scan, minhash_dedup, piece_codec, quality_rules, source_mix, toxicity,
)
from strataflow.llm.graph import components
from strataflow.llm.queries import TOKENIZERS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, doc string, row string, size long, block long, score double"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n=80):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(WORDS) for _ in range(n))


LONG = prose(99, 30_000)


def rows():
    plain = [
        (1, prose(1), "en", "a"),
        (2, prose(1), "en", "b"),  # a copy
        (3, prose(2) + " more", "en", "a"),
        (3, prose(2) + " more", "en", "a"),  # a repeated row
        (4, None, "en", "a"),
        (5, "", None, None),
        (6, " \n\t ", "de", "b"),
        (None, prose(3), "de", None),
        (None, None, None, None),
        (7, "one", "de", "c"),
        (8, "ONE", "de", "c"),
        (9, LONG, "en", "a"),
        (10, "12345 67890", None, "b"),
    ]
    return [(*r, 0, 7, True, "x", "y", 3, 4, 0.5) for r in plain]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def model():
    with open(f"{TOKENIZERS}/piece_bpe_32k.model", "rb") as file:
        return file.read()


def by_id(df, *columns):
    return sorted(((r["doc_id"], *[r[c] for c in columns]) for r in df.select("doc.doc_id", *columns).collect()), key=str)


def test_quality_rules(docs, none):
    got = by_id(quality_rules.quality_rules(docs), "n_words", "base_failed", "kept")
    assert len(got) == len(rows())
    assert (4, 0, True, False) in got and (5, 0, True, False) in got and (6, 0, True, False) in got
    assert (1, 80, False, True) in got and got.count((3, 81, False, True)) in (0, 2)
    assert (9, 30_000, False, True) in got
    assert quality_rules.quality_rules(none).count() == 0
    kept = quality_rules.keep_quality(docs)
    assert kept.columns == docs.columns and kept.where("n_words <> 7").count() == 0


def test_repeated_windows(spark):
    texts = ["a b c a b c", "a a a a", "a b c d", "a b c x a b c d b c d", " ".join(["x"] * 10)]
    got = quality_rules.quality_rules(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string"))
    assert [r[1] for r in by_id(got, "n_repeat_words")] == [6, 4, 0, 10, 10]


def test_beta_prior_shrinks_small_hosts():
    a, n = quality_rules.beta_prior(1000, 100, 1000 * 100.0, 100 * 0.1 * 1.0, 10)
    assert 0 <= a <= n and abs(a / n - 0.1) < 1e-9


def test_bad_host_is_rejected(spark):
    rows = [(i, prose(i) if i % 10 == 0 else "short", "bad") for i in range(100)] + [(1000 + i, prose(i), f"good{i % 5}") for i in range(200)]
    got = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r[0] for r in by_id(got.where("kept"), "kept")}
    assert kept == {i for i, _, s in rows if s != "bad"}


def test_license_scan(spark, docs, none):
    got = by_id(license_scan.scan_licenses(docs), "n_words", "labels", "score")
    assert (4, 0, [], 0.0) in got and (5, 0, [], 0.0) in got and len(got) == len(rows())
    assert license_scan.scan_licenses(none).count() == 0
    texts = ["Licensed under CC BY-NC 4.0. CC-BY", "All rights RESERVED. all rights reserved", "cc buy, rights reserved", "Released under the MIT License.", "İ cc by K"]
    found = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    places = {r[0]: ([p["start"] for p in r[1]], r[2]) for r in by_id(found, "base_places", "labels")}
    assert sorted(places[0][0]) == [2, 7] and places[0][1] == ["cc-by", "cc-by-nc"]
    assert sorted(places[1][0]) == [0, 3] and places[1][1] == ["reserved"]
    assert places[2] == ([], []) and places[3][1] == ["mit"] and places[4] == ([], [])  # a no-break space is part of a word


def test_whole_notices_are_found_though_words_differ(spark):
    whole = {t.label: t.text for t in license_scan.TEMPLATES}
    mit, bsd = whole["mit"], whole["bsd-3-clause"]
    half = prose(5, 300)
    texts = [
        f"{half} {mit} {half}",
        mit.replace("granted, free of charge", "granted, entirely free of charge").replace("subject to the", "subject always and everywhere to the"),
        "redistribution and use in source and binary forms, with or without any modification, are permitted",
        f"{half}\n{bsd.upper()}\n{half}",
        mit.replace("free of charge", "for a fee"),
        "permission free charge granted hereby software person obtaining copy",
        "# " + mit.replace("\n", "\n# "),
        half,
        "x " * 200_000 + whole["apache-2.0"],
        " ".join([mit] * 3),
    ]
    found = by_id(license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), "labels", "score", "places")
    labels = [r[1] for r in found]
    assert labels[0] == labels[1] == labels[6] == ["mit"] and found[0][2] == 1.0 and 0.9 < found[1][2] < 1
    near = lambda place, at: 0 <= at - place["start"] <= 2 * license_scan.SLACK
    assert near(found[0][3][-1], 300)
    assert labels[2] == ["bsd"] and "bsd-3-clause" in labels[3] and labels[7] == []
    assert labels[4] == labels[5] == [] and labels[8] == ["apache-2.0"] and near(found[8][3][-1], 200_000)
    assert labels[9] == ["mit"] and all(any(near(p, at) for p in found[9][3]) for at in (0, 163, 326))


def test_every_notice_is_found_by_itself(spark):
    texts = [(n, t.text) for n, t in enumerate(license_scan.TEMPLATES)]
    found = by_id(license_scan.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")), "labels", "score")
    assert all(license_scan.TEMPLATES[n].label in labels and score == 1.0 for n, labels, score in found)


def test_source_mix(docs, none):
    got = source_mix.mix_sources(docs, ("doc_id", "source")).select("doc.doc_id", "size", "source_size", "target", "taken", "copies").collect()
    assert len(got) == len(rows())
    assert all(r.taken <= 2 * r.size and r.target <= 2 * r.source_size for r in got)
    assert sum(r.taken for r in got) <= 1.5 * sum(r["size"] for r in got)
    again = source_mix.mix_sources(docs.repartition(5), ("doc_id", "source")).select("doc.doc_id", "size", "source_size", "target", "taken", "copies").collect()
    assert sorted(got, key=str) == sorted(again, key=str)
    assert source_mix.mix_sources(none).count() == 0
    assert source_mix.apply_mix(docs).columns == docs.columns


def test_targets_are_filled_by_weight(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 500)], "source string, size long")
    got = {r.source: r.target for r in source_mix.source_targets(sizes).collect()}
    # 3765 in all; a (weight 5) is full at 20, b (2), c (1) and null (5, the turn repeats) share the rest until null is full at 1000.
    assert got["a"] == 20 and got[None] == 1000
    assert abs(got["b"] - (3765 - 1020) * 2 / 3) < 1e-9 and abs(got["c"] - (3765 - 1020) / 3) < 1e-9


def test_language_id(docs, none):
    model = language_id.learn_from_documents(docs)
    got = by_id(language_id.identify(docs, model), "lang_pred", "score", "rejected")
    assert len(got) == len(rows())
    assert (4, "und", 0.0, True) in got and (10, "und", 0.0, True) in got and (5, "und", 0.0, True) in got
    assert all(r[1] in ("en", "de", "und") for r in got)
    assert language_id.learn_from_documents(none) is None
    assert {r[1] for r in by_id(language_id.identify(docs, None), "lang_pred")} == {"und"}
    assert language_id.identify(none, model).count() == 0
    assert language_id.keep_known_languages(docs).columns == docs.columns


def test_kneser_ney_sums_to_one():
    import numpy as np

    text = "abracadabra abba cab"
    padded = "   " + text
    counts = {}
    for i in range(len(text)):
        counts["xx", padded[i : i + 4]] = counts.get(("xx", padded[i : i + 4]), 0) + 1
    model = language_id.kneser_ney(counts)
    for context in ("abr", "rab", "   ", "zzz"):
        texts = [context + c for c in sorted(set(text))]
        total = 0.0
        for t in texts:
            codes = np.array([ord(c) for c in t], dtype=np.uint32)
            keys = language_id.gram_keys(codes, np.array([0]), 4)
            total += 2 ** float(model.log2(*keys, 4, np.array([3]))[0, 0])
        assert 0.9 < total <= 1.0001  # the rest is for characters never seen


def test_chat_format(spark):
    log = [
        (1, 0, 1, "message", "user", "hi <|im_end|> \\ <\\|"),
        (1, 1, 2, "message", "assistant", ""),
        (1, 1, 3, "delta", None, "Hel"),
        (1, 1, 4, "delta", None, "lo"),
        (1, 1, 5, "regenerate", None, None),
        (1, 1, 6, "delta", None, "Good "),
        (1, 1, 7, "delta", None, "day"),
        (1, 0, 8, "edit", None, "hello"),
        (2, 0, 1, "message", "user\nx", None),
        (None, None, None, "message", None, "lost"),
    ]
    events = spark.createDataFrame(log, "conv_id long, turn long, seq long, kind string, role string, text string")
    formatted = chat_format.format_chats(events)
    read = formatted.select("conv_id", "n_turns", chat_format.read_messages(F.col("formatted")).alias("m"), chat_format.read_trained(F.col("formatted"), F.col("spans")).alias("t"))
    got = {r.conv_id: ([tuple(m) for m in r.m], r.t) for r in read.collect()}
    assert got[1] == ([("user", "hello"), ("assistant", "Good day")], ["Good day"])
    assert got[2] == ([("user\nx", "")], [])
    assert got[None] == ([("", "lost")], [])
    assert chat_format.format_chats(events.limit(0)).count() == 0


def test_chat_round_trip(spark):
    draw = random.Random(5)
    pieces = ["<|im_start|>", "<|im_end|>", "\\", "|", "<", "<\\|", "\n", "assistant", "é", "🙂", "\\n", "$1", ""]
    turns = [(c, t, draw.choice(["user", "assistant", "a\\nb", "\n", "\\"]), "".join(draw.choice(pieces) for _ in range(draw.randint(0, 12)))) for c in range(60) for t in range(draw.randint(1, 6))]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_chats(chat_format.events_of_turns(table))
    read = formatted.select("conv_id", chat_format.read_messages(F.col("formatted")).alias("m"), chat_format.read_trained(F.col("formatted"), F.col("spans")).alias("t"))
    for r in read.collect():
        own = [(role, text) for c, _, role, text in turns if c == r.conv_id]
        assert [tuple(m) for m in r.m] == own
        assert r.t == [text for role, text in own if role == "assistant"]


def test_chat_log_with_strays_and_repeats(spark):
    log = [
        (1, 0, 1, "message", "user", "a"),
        (1, 0, 2, "delta", None, "b"),
        (1, 0, 2, "delta", None, "b"),  # delivered twice
        (1, 0, 3, "tool_ping", "tool", "NOISE"),
        (1, 0, 4, None, None, "NOISE"),
        (1, 0, 5, "delta", None, "b"),  # says the same again
        (2, 0, 1, "ping", None, "only noise"),
        (3, None, 1, "message", "assistant", "long " * 400_000),
    ]
    events = spark.createDataFrame([(*e, 7, 8, "x") for e in log], "conv_id long, turn long, seq long, kind string, role string, text string, part int, n int, again string")
    got = {r.conv_id: r for r in chat_format.format_chats(events).select("conv_id", chat_format.read_messages(F.col("formatted")).alias("m")).collect()}
    assert [tuple(m) for m in got[1].m] == [("user", "abb")] and 2 not in got
    assert got[3].m[0]["text"] == "long " * 400_000


def test_streamed_log_folds_to_the_turns(spark):
    draw = random.Random(6)
    turns = [(c, t, draw.choice(["user", "assistant", None]), draw.choice(["", None, "é🙂", "ab", "abc", "a longer text <|im_end|>", "x" * 1000])) for c in range(40) for t in (0, 1, 1, None)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    log = chat_format.streamed_turns(table)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    whole, streamed = ({tuple(map(str, r)) for r in chat_format.format_chats(e).collect()} for e in (chat_format.events_of_turns(table), log.repartition(5)))
    assert whole == streamed and len(whole) == 40


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (3, 0), (9, 0), (2, 1), (7, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(docs, labels)
    got = by_id(toxicity.score_toxicity(docs, model), "score", "predicted")
    assert len(got) == len(rows()) and all(0 <= r[1] <= 1 and r[2] == (r[1] >= 0.7) for r in got)
    assert toxicity.score_toxicity(none, model).count() == 0
    blank = toxicity.learn_toxicity(docs, labels.where("toxic = 0"))
    assert len({r[1] for r in by_id(toxicity.score_toxicity(docs, blank), "score")}) == 1


def test_near_duplicates(spark, docs, none):
    got = by_id(minhash_dedup.near_duplicates(docs, width=2), "n_shingles", "component_id", "kept")
    assert len(got) == len(rows())
    plain = {r[0]: r[1:] for r in got if r[0] is not None}
    assert plain[1][1:] == (1, True) and plain[2][1:] == (1, False) and plain[8] == (1, 7, False)
    assert plain[4] == (0, 4, True) and plain[6] == (0, 6, True) and plain[9][1:] == (9, True)
    assert minhash_dedup.near_duplicates(none).count() == 0
    left = minhash_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in left.collect())
    assert ids.count("3") == 1 and "2" not in ids and "8" not in ids and "4" in ids


def test_large_groups_of_near_copies(spark):
    draw = random.Random(3)
    table = []
    for group in range(3):
        base = prose(group * 1000, 200).split()
        for copy in range(60):
            words = list(base)
            for _ in range(6):
                words[draw.randrange(len(words))] = f"w{draw.random()}"
            table.append((len(table), " ".join(words)))
    table += [(1000 + i, prose(5000 + i, 200)) for i in range(60)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(table, "doc_id long, text string"), width=2).select("doc.doc_id", "component_id").collect()
    assert {r.doc_id: r.component_id for r in got} == brute_force_components(table, 2)


def brute_force_components(table, width):
    sets = {i: {tuple(t.split()[k : k + width]) for k in range(len(t.split()) - width + 1)} for i, t in table}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in sets:
        for b in sets:
            if a < b:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    label[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}


def test_blocks_by_shingles_lose_no_link(spark, monkeypatch):
    """Rows that stand apart from their bucket's hub, compared in many small blocks of full sets."""
    draw = random.Random(3)
    shared = [f"s{k}" for k in range(60)]
    texts = [" ".join([*shared, *[f"g{g}w{k}" for k in range(140)], f"own{draw.random()}"]) for g in range(12) for _ in range(6)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    whole = sorted(map(tuple, minhash_dedup.near_duplicates(docs).select("doc.doc_id", "component_id").collect()))
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", 3)
    assert sorted(map(tuple, minhash_dedup.near_duplicates(docs).select("doc.doc_id", "component_id").collect())) == whole
    assert whole == [(i, i - i % 6) for i in range(72)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 60), (60, 100), (70, 70), (80, 90), (90, 85)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 60, 60: 60, 70: 70, 80: 80, 85: 80, 90: 80}
    assert {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"), one_task_links=0).collect()} == got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_vectors(spark):
    draw = random.Random(1)
    base = [[draw.gauss(0, 1) for _ in range(16)] for _ in range(5)]
    table = [(k * 100 + i, [x + draw.gauss(0, 0.02) for x in b], 0) for k, b in enumerate(base) for i in range(30)]
    table += [(1000, base[0], 1), (1001, base[0], 1), (1002, [2 * x for x in base[0]], 1), (1003, None, 1), (1004, [0.0] * 16, 1), (1005, [float("nan")] + base[0][1:], 1), (1006, [], 1), (1007, [None, *base[0][1:]], 1), (1008, base[0][:4], 1), (None, base[1], 1)]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<double>, n_links int")
    small = lattice_dedup.Lattice(block_rows=8)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice_dedup.near_vectors(frame, shape=small).select("doc.vec_id", "n_links", "component_id", "kept").collect()}
    assert got[1000] == (32, 0, False) and got[0] == (32, 0, True) and got[1002][0] == 32
    assert got[105] == (30, 100, False) and got[None] == (30, 100, False) and got[205] == (29, 200, False)
    assert all(got[i] == (0, i, True) for i in (1003, 1004, 1005, 1006, 1007, 1008))
    assert lattice_dedup.near_vectors(frame.limit(0)).count() == 0


def test_lattice_recall(spark):
    import numpy as np

    draw = np.random.default_rng(4)
    x = draw.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = draw.normal(size=(400, 64))
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    z = 0.951 * x + np.sqrt(1 - 0.951**2) * y
    table = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, z]))]
    got = lattice_dedup.near_vectors(spark.createDataFrame(table, "vec_id long, embedding array<double>")).where("n_links > 0").count()
    assert got >= 0.97 * 800


def test_piece_codec(spark, docs, none, model):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    got = piece_codec.encode_and_decode(docs, model, ("doc_id", "text")).select("doc.text", "ids", "decoded").collect()
    assert len(got) == len(rows())
    for r in got:
        ids = lib.encode(r.text or "", add_bos=True, add_eos=True)
        assert hashlib.sha256(bytes(r.ids)).digest() == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).digest()
        assert r.decoded == lib.decode(ids)
    assert piece_codec.encode_and_decode(none, model).count() == 0


def test_piece_codec_on_hostile_texts(model):
    import numpy as np
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    encode = piece_codec.text_encoder(piece_codec.read_vocabulary(model), memo_words=50)
    draw = random.Random(2)
    pieces = [lib.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    letters = [*"abcdeinotrs  \n\t.,'éêß0123─▁한", "the", "ing", "  ", " " * 15, " " * 31, "<s>", "<0x0A>", "\x00"]
    texts = ["", " ", "\n", "▁", " " * 47, "a" * 300]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(1, 50))) for _ in range(3000)]
    texts += ["".join(draw.choice(pieces) for _ in range(draw.randint(1, 6))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == lib.encode(text, add_bos=True, add_eos=True), text


def test_pipeline_encodes_small_batches(spark, monkeypatch):
    from collections.abc import Iterator

    import pandas as pd

    def rows_of_batch(model, vocabulary, memo_words):
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame({"ids": [bytes(4 * len(batch))] * len(batch), "decoded": [""] * len(batch)})

        return run

    monkeypatch.setattr(piece_codec, "_codec", rows_of_batch)
    docs = spark.range(2500, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    got = [r.n_tokens for r in corpus_pipeline.encode(spark, docs, "").select("n_tokens").collect()]
    assert len(got) == 2500 and max(got) <= 100


def test_lattice_lm(spark, docs, none, model):
    score = lambda d: lattice_lm.score_texts(d, model, language_id.remainder("doc_id", 10) == 0)
    got = by_id(score(docs), "n_tokens", "n_known", "score", "base_score")
    assert len(got) == len(rows())
    assert {r[1] for r in got if r[0] in (4, 5, 6)} == {1}
    assert any(r[1] == 30_001 for r in got) and all(r[3] < 0 for r in got)
    assert score(none).count() == 0
    alone = by_id(lattice_lm.score_texts(docs, model, F.lit(True)), "n_known", "base_score")
    assert all(r[1] == 0 for r in alone)


def test_lattice_sums_all_segmentations(model):
    import itertools
    import math

    own = lattice_lm.vocabulary_model(model)
    for word in ("the", "tion", "ü", "日x", "ab\x00"):
        text = lattice_lm.SPACE + word
        total = 0.0
        for cuts in itertools.product((False, True), repeat=len(text) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
            log = 0.0
            for a, b in zip(at, at[1:]):
                log += piece_log(own, text[a:b])
            total += math.exp(log)
        assert math.isclose(own.word_logs([word])[0], math.log(total), rel_tol=1e-9)


def piece_log(own, piece):
    import numpy as np

    key = lattice_lm._ones(np.array([ord(piece[0])], dtype=np.uint32))
    for c in piece[1:]:
        key = lattice_lm._roll(key, lattice_lm._ones(np.array([ord(c)], dtype=np.uint32)))
    final = lattice_lm._final(key)[0]
    at = int(np.searchsorted(own.hashes, final))
    if at < own.pieces and own.hashes[at] == final:
        return own.logs[at]
    return sum(own.logs[own.pieces + b] for b in piece.encode()) if len(piece) == 1 else -np.inf


def test_pipeline_on_edge_rows_and_nothing(spark, docs, none, tmp_path):
    for name, table, least in (("edges", docs.unionByName(docs), 3), ("nothing", none, 0), ("nulls", docs.where("text IS NULL"), 0)):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path / name))
        assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        rows = got.collect()
        assert len(rows) >= least and all(r.n_tokens > 2 for r in rows)
        if name == "edges":
            assert max(sum(r.doc_id == d for r in rows) for d in {r.doc_id for r in rows}) <= 2
            assert {9} <= {r.doc_id for r in rows} <= {1, 2, 3, 9, None}
