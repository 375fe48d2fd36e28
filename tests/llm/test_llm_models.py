"""Toxicity, licences, SentencePiece, archives and the pipeline."""

import io
import re

import numpy as np
import pandas as pd
import pytest
import sentencepiece
import xxhash

import corpus_pipeline
from fixtures_llm import EDGE, counted
from rostra.llm import licences, pieces, toxicity, warc
from rostra.session import shared_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(pieces.model_path())


@pytest.fixture(scope="module")
def unigram():
    """The library itself, with the model's pieces taken as those of a unigram model."""
    data = bytearray(open(pieces.model_path(), "rb").read())
    place = data.rindex(b"\x18\x02 \x80\xfa\x01")  # model_type, vocab_size
    data[place + 1] = 1
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(data))


def ids_of(blob):
    return np.frombuffer(blob, "<i4").tolist()


def test_pieces_equal_the_library(model, unigram):
    lattice = pieces.Lattice(model)
    for text in ("This is the end of the characteristics, nothing else", "un deux trois", "representatives of x"):
        best = unigram.nbest_encode_as_ids(text, 2)[0]
        assert ids_of(lattice.encode(text)) == best
        assert unigram.decode(best) == text == pieces.decoder(model)(best)


@pytest.mark.parametrize("text", ["", " a  b\n\tc ", "ﬁ①é 日本語", "a\0b", "▁x ▁", "  " * 50, "x" * 300])
def test_pieces_round_trip(model, text):
    lattice = pieces.Lattice(model)
    together = lattice.encode(text)
    alone = b"".join(pieces.Lattice(model).word(w)[0] for w in lattice.cut.findall(lattice.normal(text)))
    assert together == alone
    if "▁" not in text:
        assert pieces.decoder(model)(ids_of(together)) == text


def test_chunks_give_what_whole_texts_give(llm, edge, model):
    lattice = pieces.Lattice(model)
    found = pieces.encode(edge, model, size=64, fanout=3).collect()
    expected = counted((i, tuple(ids_of(lattice.encode(t or "")))) for i, t in EDGE)
    assert counted((r["doc_id"], tuple(r["ids"])) for r in found) == expected
    assert all(r["round_trip"] for r in found)
    back = pieces.decode(pieces.encode(edge, model), model).collect()
    assert counted((r["doc_id"], r["decoded"]) for r in back) == counted((i, t or "") for i, t in EDGE)


@pytest.fixture(scope="module")
def characters(llm):
    return toxicity.character_model(llm.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_disguised_words_are_restored(characters):
    restore = toxicity.Restorer(characters).restore
    for disguised in ("1d10t", "!diot", "iiidiot", "i.d.i.o.t", "IDIOT!!", "i-d-i-0-t"):
        assert restore(disguised) == "idiot"
    assert restore("Thing,") == "thing" and restore("") == "" and restore("2024") == restore("2024")


def test_words_beside_a_disguised_word(characters):
    """A separator or a space may be the border of a word."""
    restorer = toxicity.Restorer(characters)
    for disguised in ("you.idiot", "such-idiot", "you/idiot", "a i d i o t", "you are an i.d.i.o.t".split()[-1]):
        assert "idiot" in restorer.readings_of(disguised).split(), disguised
    assert restorer.readings_of("plain") == "plain" and "idiot" in restorer.readings_of("1d10t").split()
    assert restorer.restore("i d i o t").replace(" ", "") == "idiot"
    assert not set(restorer.restore("@$$") + restorer.restore("455")) & set("@$45")
    assert set(toxicity.parts_of("you idiot")) >= {"=you", "=idiot", "^idio", "^idiot"}


def test_spelled_words_are_read_as_one(llm, characters):
    docs = llm.createDataFrame([(1, "he is an i d i o t today"), (2, None)], "doc_id bigint, text string")
    found = {r["doc_id"]: r["restored"] for r in toxicity.restored(docs, characters).collect()}
    assert found == {1: "he is an idiot today", 2: ""}


def test_toxicity_on_awkward_rows(edge, labels, nothing):
    found = toxicity.score(edge, labels).collect()
    assert counted(r["doc_id"] for r in found) == counted(i for i, _ in EDGE)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.score(nothing, labels).count() == 0
    assert {r["score"] for r in toxicity.score(edge, labels.limit(0)).collect()} == {0.0}


def test_toxicity_on_held_out_rows(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = llm.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = toxicity.fold("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT_FOLD
    rows = toxicity.score(docs, labels).join(labels, "doc_id").where(held).collect()
    toxic = [r["score"] for r in rows if r["toxic"]]
    clean = [r["score"] for r in rows if not r["toxic"]]
    assert np.mean([[(t > c) + 0.5 * (t == c) for c in clean] for t in toxic]) > 0.8


def test_licences(llm, edge, nothing):
    found = licences.licences(edge).collect()
    assert counted((r["doc_id"], tuple(r["families"])) for r in found) == counted(
        (i, ("mit",) if t and "MIT License" in t else ()) for i, t in EDGE
    )
    assert licences.licences(nothing).count() == 0
    texts = [
        (1, "Distributed under the terms of the Apache License, Version 2.0", "apache"),
        (2, "Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        (3, "He lost the license of the car under the terms of the contract.", None),
        (4, "x y z\nThis work is licensed under the GNU General Public License, version 3.", "gpl"),
        (5, "the software of the public was released", None),
    ]
    docs = llm.createDataFrame([(i, t) for i, t, _ in texts], "doc_id bigint, text string")
    found = {r["doc_id"]: r["families"] for r in licences.licences(docs).collect()}
    assert found == {i: [f] if f else [] for i, _, f in texts}


LICENSED = [
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the\nfollowing conditions are met:", "bsd"),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", "gpl"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\n"
     "file, You can obtain one at https://mozilla.org/MPL/2.0/.", "mpl"),
    ("some words\n\nThis library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
     "License as published by the Free Software Foundation\n\nmore words", "lgpl"),
    ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published by\n"
     "the Free Software Foundation", "agpl"),
    ("plain words of a text " * 60 + "Released under the MIT License. " + "and others after it " * 70, "mit"),
    ("To the extent possible under law, Some One has waived all copyright and\nrelated or neighboring rights to this work", "cc0"),
]


def test_licences_of_wrapped_and_tagged_texts(llm):
    prose = [f"the {w} of a contract was read in the house on a day of spring and the version of it is free number {n}" for n, w in enumerate(["terms", "license", "work", "text"] * 60)]
    rows = [(i, t) for i, (t, _) in enumerate(LICENSED)] + [(1000 + i, t) for i, t in enumerate(prose)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["families"] for r in licences.licences(docs).collect()}
    assert {i: found[i] for i in range(len(LICENSED))} == {i: [f] for i, (_, f) in enumerate(LICENSED)}
    assert not any(found[1000 + i] for i in range(len(prose)))


def test_licence_scores_equal_plain_python(llm, edge):
    texts = [t for t, _ in LICENSED] + [t for _, t in EDGE if t] + ["a b\n \t\n" + "MIT License word " * 90]
    model = licences.fit([["the", "license", "of", "a", "car"], ["plain", "words"]])

    def score(words):
        grams = licences.grams_of(words)
        z = np.array(model.bias) + sum((np.array(model.features[g]) for g in sorted(grams) if g in model.features), np.zeros(len(model.bias)))
        k, p = int(z.argmax()), np.exp(z - z.max())
        own = [licences.grams_of(licences.words_of(t), 2) for f, t in licences.templates() if f == model.classes[k]]
        return model.classes[k], 1 / p.sum(), max((len(o & grams) / len(o) for o in own), default=0.0)

    def cut(text):
        for block in re.split(r"\n[ \t\r\f]*\n", text):
            words = licences.words_of(block)
            for at in range(0, max(1, -(-(len(words) - licences.WINDOW) // licences.STRIDE) + 1)):
                if words:
                    yield words[at * licences.STRIDE : at * licences.STRIDE + licences.WINDOW]

    docs = llm.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, paragraphs int")
    found = {r["doc_id"]: r["paragraphs"] for r in licences.classify(docs, model).collect()}
    anchors, many = set(model.anchors), 0
    for i, text in enumerate(texts):
        expected = [score(w) for w in cut(text) if anchors & set(w)]
        many += len(expected)
        assert [p["family"] for p in found[i]] == [f for f, _, _ in expected]
        assert np.allclose([(p["probability"], p["coverage"]) for p in found[i]], [e[1:] for e in expected]) if expected else not found[i]
    assert many > 15


def test_archive_layout():
    records = [warc.make_record(i, "http://x/ y", b"payload %d" % i * 50, None, False, warc.DATE) for i in range(200)]
    out = io.BytesIO()
    warc.write_archive(out, records)
    data = out.getvalue()
    assert data[:4] == b"\x5d\x2a\x4d\x18" and len(data) < sum(map(len, records)) / 3
    assert list(warc.read_archive(io.BytesIO(data), piece=7)) == records
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(data[:-3])))
    few = io.BytesIO()
    warc.write_archive(few, records[:1])
    assert list(warc.read_archive(io.BytesIO(few.getvalue()))) == records[:1]


def test_archives(llm):
    rows = [(1, "u", "same"), (5, None, "same"), (3, "u\r\nX: y", "same"), (2, "u", None), (4, "u", ""), (None, "u", "same"), (6, "u", "é" * 999), (6, "u", "é" * 999)]
    pages = llm.createDataFrame([(*r, "d", 1) for r in rows], "page_id bigint, url string, html string, digest string, original int")
    out = shared_dir(llm, "test-warc")
    manifest = warc.write_archives(pages, out)
    found = warc.read_archives(manifest, out, with_payload=True).collect()
    largest = {"same": 5, "": 4, "é" * 999: 6}
    expected = []
    for i, _, t in rows:
        t = t or ""
        first = i == largest[t]
        expected.append((i, len(t.encode()), warc.digest(t.encode()), "response" if first else "revisit", None if first else largest[t]))
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert counted(tuple(r[f] for f in fields) for r in found) == counted(expected)
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in found)
    none = shared_dir(llm, "test-warc")
    assert warc.read_archives(warc.write_archives(pages.limit(0), none), none).count() == 0
    all_stored = warc.write_archives(pages, shared_dir(llm, "test-warc"), least=5000)
    assert warc.read_archives(all_stored, out).where("record_type = 'revisit'").count() == 0


def test_pipeline_stages(llm, edge):
    """Each stage on its own input: rows come from the input, decisions take effect."""
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages)[1] == "SimHash near-dedup" and len(stages) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(llm, docs, SF)
        assert after.columns == docs.columns
        rows = {r["doc_id"]: r["text"] for r in after.collect()}
        assert rows.keys() <= before.keys()
        if name != "secret scans":
            assert len(rows) < len(before) and all(before[i] == t for i, t in rows.items())
        else:
            assert rows.keys() == before.keys()
        if name == "SimHash near-dedup":
            assert len(set(rows.values())) == len(rows)


def test_pipeline_equals_its_stages(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        out = shared_dir(llm, "test-stage")
        stage(llm, docs, SF).write.parquet(out)
        docs = llm.read.parquet(out)
    expected = pd.DataFrame([(r["doc_id"], tuple(r["ids"])) for r in docs.collect()]).sort_values(0)
    found = pd.DataFrame([(r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(llm, SF).collect()]).sort_values(0)
    assert found.values.tolist() == expected.values.tolist()


def test_merges_equal_the_library_as_it_is(llm, edge, model):
    """The encoded documents have the ids of the unpatched library, whole and in chunks."""
    own = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    docs = llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = ["The quick brown fox jumps", " a  b\n\tc ", "ﬁ①é 日本語", "a\0b", "▁x ▁", "  " * 50, "x" * 300, "<s> </s> <0x41> <unk>"]
    more = llm.createDataFrame([(10_000_000 + n, t) for n, t in enumerate(odd)], "doc_id bigint, text string")
    rows = docs.limit(200).unionByName(edge.select("doc_id", "text")).unionByName(more)
    expected = counted((r["doc_id"], tuple(own.encode(r["text"] or ""))) for r in rows.collect())
    assert counted((r["doc_id"], tuple(r["ids"])) for r in pieces.encoded_documents(rows).collect()) == expected
    small = pieces.encode(rows, model, size=64, by_merges=True).collect()
    assert counted((r["doc_id"], tuple(r["ids"])) for r in small) == expected
    assert all(r["round_trip"] for r in small if r["doc_id"] != 10_000_004)  # a '▁' decodes to a space


def test_pairs_leave_what_merges_leave(model):
    """Of every word seen and of odd ones there is a sequence of allowed pairs, and it is the library's."""
    own = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    pairs, rng = pieces.Pairs(model), np.random.default_rng(6)
    texts = [r["text"] or "" for r in pd.read_parquet(f"{SF}/documents.parquet").to_dict("records")]
    words = {w for t in texts for w in pairs.cut.findall(pairs.normal(t))}
    words |= {"".join(rng.choice(list("abehinorstx\u2581日é①"), int(n))) for n in rng.integers(1, 60, 1500)}
    words |= {"x" * n for n in range(1, 90)} | {("ab" * n)[: 2 * n - n % 2] for n in range(1, 60)} | {"aab" * 40, "=" * 77, "ha" * 41 + "h"}
    for word in words:
        _, (last,) = pairs.paths(word, 0, [(0, 0)], pairs.sizes(word))
        assert last[-1] >= 0 and pairs.back(word, last, len(word), 0) == pairs.merged(word)
    for text in texts[:60]:
        assert ids_of(pairs.encode(text)) == own.encode(text)


def test_short_words_are_merged_without_a_queue(model, monkeypatch):
    """A queue for every new word was most of the time; the pieces are the same, also past the length for lists."""
    rng, pairs = np.random.default_rng(8), pieces.Pairs(model)
    texts = [r["text"] or "" for r in pd.read_parquet(f"{SF}/documents.parquet").to_dict("records")]
    words = {w for t in texts for w in pairs.cut.findall(pairs.normal(t))}
    words |= {"".join(rng.choice(list("abehinorstx\u2581日é①"), int(n))) for n in rng.integers(0, 2 * pieces.SHORT_WORD, 1500)}
    words |= {"x" * n for n in range(2 * pieces.SHORT_WORD)}
    expected = {w: pairs._merged_by_queue(w) for w in words}
    assert {w: pairs.merged(w) for w in words} == expected

    def never(*_):
        raise AssertionError("a queue was made")

    monkeypatch.setattr(pieces.heapq, "heapify", never)
    for word in words:
        if len(word) <= pieces.SHORT_WORD:
            assert pairs.merged(word) == expected[word]
    assert ids_of(pairs.encode("The quick brown ﬁ① fox")) == sentencepiece.SentencePieceProcessor(model_file=pieces.model_path()).encode(
        "The quick brown ﬁ① fox"
    )


@pytest.mark.parametrize("size", [3, 40, 64])
def test_long_words_meet_the_borders(llm, model, size):
    """Chunks inside words, of less and of more characters than a piece has, give the library's ids."""
    own = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    rng = np.random.default_rng(size)
    letters = "".join(rng.choice(list("etaoinshrdlu"), 2000))
    texts = [letters, "x" * 700, "ab" * 500, "the" * 300 + " " + letters[:100], "中文字符日本語テキスト" * 60, " " * 90 + "a", "a\n" * 50 + letters[:90],
             "no such long word here at all but many short ones " * 9, "é①ﬁ" * 99, "\n" * 70, "a" + " " * 64 + "b", letters[:64], letters[:65]]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in pieces.encode(docs, model, size=size, fanout=3, by_merges=True).collect()}
    for i, text in enumerate(texts):
        assert found[i]["ids"] == own.encode(text) and found[i]["round_trip"]


def test_very_long_words(llm, model):
    own = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("etaoinshrdlucmfw"), 300_000)), "中文字符日本語テキスト" * 9_000]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["ids"] for r in pieces.encode(docs, model, by_merges=True).collect()}
    assert [found[i] for i in range(2)] == [own.encode(t) for t in texts]


def test_near_dedup_keeps_what_plain_python_keeps(llm):
    """Of texts whose fingerprints lie within two bits, by chains too, the smallest identifier stays."""
    rng = np.random.default_rng(5)
    words = [f"w{n}" for n in range(3000)]
    rows = []
    for group in range(12):
        base = list(rng.choice(words, 300))
        for copy in range(5):
            text = list(base)
            for place in rng.choice(300, (0, 1, 1, 2, 40)[copy], replace=False):
                text[place] = f"new{group}_{copy}"
            rows.append((1000 + 100 * group + 7 * (copy % 3) + copy, " ".join(text)))
    rows += [(9001, rows[0][1]), (9002, None), (9003, ""), (None, "only here"), (None, "only here"), (9004, "only here")]

    def fingerprint(text):
        w = (text or "").split()
        hashes = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))

    fps = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    near = 0
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                near += fps[a] != fps[b]
                label = [label[b] if x == label[a] else x for x in label]
    expected = {}
    for (i, _), x in zip(rows, label, strict=True):
        expected[x] = min(expected.get(x, i or 10**9), i or 10**9)
    assert near > 5
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    found = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](llm, docs, SF).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(expected.values())
