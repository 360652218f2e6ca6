"""Each operator against plain code over small tables with odd rows."""

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
import public_tokenizers
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioscope.llm import bpe, caps, chat, exact, licences, packing, ring, simhash, token_counts, toxicity

ROWS = "doc_id long, text string, score string, SHARD int, name string"
WORDS = "the quick brown fox jumps over lazy dogs while seven wizards box quietly near old Ørsted".split()


def texts():
    rng = np.random.default_rng(1)
    made = [" ".join(rng.choice(WORDS, size=n)) for n in rng.integers(1, 60, size=60)]
    made += made[:20] + [t.upper() for t in made[:5]] + ["", "", None, " \t\n", "ß ẞ İ", "a" * 9001, "a" * 9000]
    return made + [made[0] + " end", "x " * 5000, "naïve 日本語 🙂 <|endoftext|> 123", "a" * 4096, "a" * 4096 + "b"]


def rows():
    table = [(k * 3, t, "s", 1, "n") for k, t in enumerate(texts())]
    return table + [(0, table[0][1], "again", 2, None), (None, "nobody", None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), ROWS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], ROWS)


def roots(many, links):
    up = list(range(many))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(many)]


def test_simhash(docs, empty):
    def plain(text):
        found = (text or "").encode().lower().split()
        grams = [b" ".join(found[k : k + 3]) for k in range(max(1, len(found) - 2))] if found else []
        ones = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
        return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams)) if grams else 0

    ids, prints = [r[0] for r in rows()], [plain(r[1]) for r in rows()]
    links = [
        (i, j) for i in range(len(ids)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2
    ]
    group = defaultdict(list)
    for i, root in enumerate(roots(len(ids), links)):
        group[root].append(i)
    want = sorted(
        (ids[i] if ids[i] is not None else -1, f"{prints[i]:016x}",
         min((ids[k] for k in members if ids[k] is not None), default=-1))
        for members in group.values()
        for i in members
    )
    for node, large in ((8192, 65536), (4, 8)):
        found = simhash.near_duplicates(docs, node=node, large=large).fillna(-1)
        assert sorted(tuple(r)[:3] for r in found.collect()) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_does_not_link_texts_that_share_an_id(spark):
    fox = "the quick brown fox jumps over the lazy dog again and again today"
    wizards = "seven wizards box quietly near an old harbour while the rain keeps on falling"
    table = [(5, fox), (5, wizards), (6, fox), (7, wizards), (7, fox), (8, "nothing like the others at all")]
    found = simhash.near_duplicates(spark.createDataFrame(table, "doc_id long, text string")).collect()
    by_text = {r.fingerprint: r["class"] for r in found}
    assert len(by_text) == len(set(by_text.values())) == 3
    assert sorted((r.doc_id, r.component_id) for r in found) == [(5, 5), (5, 5), (6, 5), (7, 5), (7, 5), (8, 8)]
    other = spark.createDataFrame([(5, fox), (5, wizards), (1, fox), (3, wizards)], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(other).collect())
    assert got == [(1, 1), (3, 3), (5, 1), (5, 3)]


def test_trie_pairs_finds_all_pairs():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, size=40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, size=(40, 6)).astype(np.uint64)
    points = np.unique(np.concatenate((base, (base[:, None] ^ flips).ravel())))
    found = {(min(a, b), max(a, b)) for i, j in simhash.trie_pairs(points, None, 2) for a, b in zip(i, j)}
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 2
    assert found == {(a, b) for a, b in zip(*np.nonzero(near)) if a < b}
    left, right = points[::2], points[1::2]
    found = sorted((a, b) for i, j in simhash.trie_pairs(left, right, 2) for a, b in zip(i, j))
    assert found == sorted(zip(*np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= 2)))


def test_exact(docs, empty):
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for who, text, *_ in rows():
        groups[(text or "").translate(small)].append(-1 if who is None else who)
    want = sorted(
        (who, max(ids), len(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for who in ids
    )

    def clashing(block, seed):  # few addresses at first, so the seed must change
        width = 4 if seed < 1 else 1 << 40
        return [F.pmod(F.xxhash64(block, F.lit(seed)), F.lit(width)), F.lit(0).cast("long")]

    for size, address in ((4096, exact.two_hashes), (7, exact.two_hashes), (4096, clashing)):
        found = exact.exact_duplicates(docs, size=size, address=address).fillna(-1).collect()
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
        kept = sorted(r.doc_id for r in found if r.kept)
        assert kept == sorted(max(ids) for ids in groups.values())
    assert exact.exact_duplicates(empty).count() == 0


def test_ring(docs, empty):
    found = ring.shard_documents(docs, shards=7, nodes=5, cells=64).collect()
    places = defaultdict(list)
    for r in found:
        places[r.shard].append(r.slot)
    assert len(found) == len(rows()) and len(places) == 7
    assert all(sorted(slots) == list(range(len(slots))) for slots in places.values())
    assert max(map(len, places.values())) - min(map(len, places.values())) <= 1
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in rows())
    assert sorted((r.size, r.text_crc32) for r in found) == want
    assert {r.law for r in found} == {"rows"} and {r.grown_shard for r in found} == {None}
    assert ring.shard_documents(empty).count() == 0


def test_ring_walk_is_the_one_row_by_row():
    counts = {c: (c * 7) % 23 for c in range(0, 64, 3)}
    where, owner = ring._owners(5, 4, 64)
    total = sum(counts.values())
    room = [total // 5 + (s < total % 5) for s in range(5)]
    want = {}
    over = []
    for cell in sorted(counts):
        at = next((k for k, w in enumerate(where) if w >= cell), 0)
        for rank in range(counts[cell]):
            if room[owner[at]]:
                room[owner[at]] -= 1
                want[cell, rank] = owner[at]
            else:
                over.append((cell, rank, at))
    for cell, rank, at in over:
        while not room[owner[at]]:
            at = (at + 1) % len(where)
        room[owner[at]] -= 1
        want[cell, rank] = owner[at]
    plan = ring.plan_ring(counts, 5, 4, 64)
    assert {(c, k): s for c, a, b, s, _ in plan for k in range(a, b)} == want


def test_licences(spark, empty):
    grant = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this\n"
        "software and associated documentation files (the Software).\nThe above copyright notice and "
        "this permission notice shall be included in all\ncopies or substantial portions of the Software."
    )
    free = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation; either version 3 of the "
        "License, or (at your option) any later version."
    )
    cases = {
        "Text.\nReleased under the MIT License.": "MIT",
        "no end\nLicensed under CC BY-NC 4.0.\nmore": "CC-BY-NC-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under the Apache License, Version 2.0.\nAll rights reserved.": "Apache-2.0;all-rights-reserved",
        grant: "MIT",
        free: "GPL-3.0-or-later",
        "The MIT License was discussed. We licensed a film.": "",
        "": "",
    }
    table = spark.createDataFrame([(k, t) for k, t in enumerate([*cases, None])], "doc_id long, text string")
    found = {r.doc_id: ";".join(r.licences) for r in licences.scan_licences(table).collect()}
    assert [found[k] for k in range(len(cases))] == list(cases.values()) and found[len(cases)] == ""
    assert licences.scan_licences(empty).count() == 0


MIT = """MIT License

Copyright (c) 2020 A. Holder

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_2 = """Copyright (c) 2020, A. Holder

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
GPL_2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""
GPL_3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.
"""


@pytest.mark.parametrize("notice,licence", [
    (MIT, "MIT"), (BSD_2, "BSD-2-Clause"), (BSD_3, "BSD-3-Clause"),
    (GPL_2, "GPL-2.0-or-later"), (GPL_3, "GPL-3.0-or-later"),
])
def test_licence_notices_however_wrapped(notice, licence):
    known = licences.compiled()
    marked = "/*\n" + "".join(f" * {line}\n" for line in notice.splitlines()) + " */\nint main;\n"
    for text in (notice, " ".join(notice.split()), "Über İ: see below.\n" + notice, notice.replace("\n", "\r\n"),
                 "\n".join(" ".join(part.split()) for part in notice.split("\n\n")), marked):
        found = licences.sentences(text, known)
        assert licences.ruled([name for _, _, name in found]) == [licence]
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:])) and found[-1][1] <= len(text)
    both = licences.sentences(notice + "\n" + MIT, known)
    assert licences.ruled([name for _, _, name in both]) == list(dict.fromkeys([licence, "MIT"]))
    torn = licences.sentences(notice.replace("hereby", "").replace("binary", "").replace("Public", ""), known)
    assert licence not in licences.ruled([name for _, _, name in torn])


def test_short_licence_sentences_stand_alone():
    known = licences.compiled()
    found = lambda text: [name for _, _, name in licences.sentences(text, known)]
    assert found("It fell into the public domain debate. Into the public domain.") == ["PUBLIC_DOMAIN"]
    assert found("// SPDX-License-Identifier: MIT\n// Copyright A. Holder") == ["SPDX:mit"]
    assert found("Licence: released under the MIT\nLicense") == ["MIT_NAME"]
    assert found("the film was not released under the MIT License") == []


def test_bpe_is_that_of_the_library(docs, empty):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    codec = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    coded = bpe.encode_documents(docs, path, public_tokenizers.PATTERN)
    found = bpe.decode_documents(coded, path).collect()
    want = sorted(
        (-1 if who is None else who, codec.encode_ordinary(text or ""), (text or "").encode())
        for who, text, *_ in rows()
    )
    ids = lambda raw: np.frombuffer(bytes(raw), dtype="<u4").tolist()
    assert sorted((-1 if r[0] is None else r[0], ids(r[1]), bytes(r[2])) for r in found) == want
    assert bpe.encode_documents(empty, path, public_tokenizers.PATTERN).count() == 0


def test_bpe_on_random_bytes():
    ranks = {bytes([k]).decode("latin-1"): k for k in range(256)}
    for k, token in enumerate("ab bc abc ca ab,ab aa aaa bab cab abca bcab".replace(",", "").split()):
        ranks.setdefault(token, 300 + k)
    coder = bpe.Backtracker(ranks, bpe.reachable(ranks))
    rng = np.random.default_rng(3)
    for size in rng.integers(1, 40, size=2000):
        piece = "".join(rng.choice(list("abc"), size=size))
        if piece not in ranks:
            assert [ranks[t] for t in bpe.merged(piece, ranks)] == coder.encode(piece)


def test_token_counts(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    scores = token_counts.zipf_scores(token_counts.load_ranks(path))

    def plain(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            ways = [
                (best[start][0] + scores[word[start:end]], best[start][1] - 1)
                for start in range(max(0, end - 130), end)
                if word[start:end] in scores
            ]
            best.append(max(ways))
        return -best[-1][1]

    import regex

    split = regex.compile(public_tokenizers.PATTERN)
    want = []
    for who, text, *_ in rows():
        found = split.findall(text or "")
        want.append((-1 if who is None else who, len(found), sum(plain(p.encode()) for p in found)))
    for nodes in (1_000_000, 10):
        got = token_counts.count_tokens(docs, path, public_tokenizers.PATTERN, nodes=nodes).fillna(-1)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert token_counts.count_tokens(empty, path, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("dims,block", [(64, 1024), (64, 16), (3, 8), (1, 1024)])
def test_caps(spark, dims, block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, dims))
    near = centres[:10, None, :] + rng.normal(size=(10, 6, dims)) * 0.1 / np.sqrt(dims)
    vectors = np.concatenate((centres, near.reshape(-1, dims), near[0], centres[:1] * 3)).astype("f4")
    table = [(k, v.tolist(), k) for k, v in enumerate(vectors)]
    odd = [None, [], [0.0] * dims, [float("nan")] * dims, [float("inf")] + [1.0] * (dims - 1), [None] * dims]
    table += [(1000 + k, v, 0) for k, v in enumerate(odd)]
    table += [(None, vectors[0].tolist(), 0), (7, vectors[7].tolist(), 9)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int")
    found = caps.near_vectors(df, block=block, bundle=512).collect()
    ids = [k for k in range(len(vectors))] + [7]
    unit = caps._unit(np.concatenate((vectors, vectors[7:8])))
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    component = roots(len(ids), [(a, b) for a, b in zip(*np.nonzero(linked)) if a > b])
    want = sorted((ids[k], int(linked[k].sum()), ids[component[k]]) for k in range(len(ids)))
    usable = [r for r in found if r.vec_id is not None and r.vec_id < 1000]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in usable) == want
    rest = [r for r in found if r.vec_id is None or r.vec_id >= 1000]
    assert len(rest) == 7 and all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in rest)
    assert caps.near_vectors(df.filter("vec_id < 0")).count() == 0


def test_caps_does_not_add_up_vectors_that_share_an_id(spark):
    east, near, north, up = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    table = [(5, east), (5, north), (6, near), (7, [0.1, 1.0, 0.0]), (7, up), (2, [0.0, 0.9, 0.0]), (5, up)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>")
    found = caps.near_vectors(df).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == [
        (2, 2, 2), (5, 1, 5), (5, 1, 5), (5, 2, 2), (6, 1, 5), (7, 1, 5), (7, 2, 2)
    ]


def test_caps_recall(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    turn = rng.normal(size=base.shape)
    turn -= (turn * base).sum(axis=1, keepdims=True) * base
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    pairs = np.concatenate((base, 0.955 * base + np.sqrt(1 - 0.955**2) * turn)).astype("f4")
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(pairs)], "vec_id long, embedding array<float>")
    assert caps.near_vectors(df).agg(F.sum("n_links")).first()[0] >= 0.98 * 6000


def test_packing(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = {"<|endoftext|>": 50256}
    for size in (2048, 16):
        found = packing.pack_documents(docs, path, size, 0, special).collect()
        pieces = []
        for who, text, *_ in rows():
            ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
            edges = [0, *range((len(ids) - 1) % size + 1, len(ids) + 1, size)]
            for k, (a, b) in enumerate(zip(edges, edges[1:])):
                pieces.append((-1 if who is None else who, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
        got = [(-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
        assert sorted(got) == sorted(pieces)
        bins = defaultdict(list)
        for r in found:
            bins[r.sequence_id].append((r.offset, r.length))
        for placed in bins.values():
            ends = [a + n for a, n in sorted(placed)]
            assert [a for a, _ in sorted(placed)] == [0, *ends[:-1]] and ends[-1] <= size
        free = []  # best fit, longest first, piece by piece
        for length in sorted((p[3] for p in pieces), reverse=True):
            fits = [k for k, space in enumerate(free) if space >= length]
            if fits:
                free[min(fits, key=lambda k: free[k])] -= length
            else:
                free.append(size - length)
        assert len(bins) == len(free)
    assert packing.pack_documents(empty, path).count() == 0


def test_packing_takes_long_runs_of_white_space(spark, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special, end = {"<|endoftext|>": 50256}, "<|endoftext|>"
    ids = lambda text: library.encode(text, add_special_tokens=False).ids
    ranks = packing.load_ranks(path)
    monkeypatch.setattr(packing, "LONG", 3)
    monkeypatch.setattr(packing, "RUN", packing.re.compile(packing.RUN.pattern.replace("65536", "3")))
    encode = packing.encoder(ranks, special)
    rng = np.random.default_rng(7)
    signs = [" ", " ", " ", "\n", "\t", "\u3000", "\x1c", "\x85", "a", "'s", "!", "7", "\u00e9", end]
    for size in rng.integers(0, 60, size=3000):
        text = "".join(rng.choice(signs, size=size))
        assert encode(text).tolist() == ids(text), repr(text)
    monkeypatch.undo()
    many = 3_000_000
    table = [(0, " " * many), (1, "a" + "\n" * many + "b"), (2, "x " + " \n\t" * (many // 3) + end + " y"), (3, "end")]
    found = packing.pack_documents(spark.createDataFrame(table, "doc_id long, text string"), path, 2048, 0, special)
    total = {r.doc_id: r.n for r in found.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert total[0] == many + 1 and total[3] == len(ids("end")) + 1 and min(total[1], total[2]) > 1000
    short = {k: t.replace(" " * many, " " * 70_000).replace("\n" * many, "\n" * 70_000)
             .replace(" \n\t" * (many // 3), " \n\t" * 30_000) for k, t in table}
    encode = packing.encoder(ranks, special)
    for text in short.values():
        assert encode(text).tolist() == ids(text)


def talk():
    system = [(1, 0, "system", "be kind"), (2, 5, "user", None), (None, 1, "user", "who?"), (None, 2, None, "")]
    said = "\\### Assistant: </turn> ok <turn a>\n\\s \\l"
    turns = [(1, k, "assistant" if k % 2 == 0 else "user", f"{said} {k} " * (k % 7)) for k in range(1, 150)]
    long = [(3, 0, "user", "word " * 3000), (3, 1, "assistant", "yes " * 2000), (3, 2, "assistant", "last")]
    tied = [(4, 1, "user", "b"), (4, 1, "user", "a"), (4, None, "assistant", "first"), (4, 1, "user", "a")]
    return system + turns + long + tied + [(5, 1, "assistant", "x"), (5, 3, "system", "late"), (6, 0, "<r>", "r")]


def test_chat(spark):
    df = spark.createDataFrame([(*r, 1) for r in talk()], "conv_id long, turn long, role string, text string, loss int")
    cut = chat.windows(df, budget=120, history=40)
    found = {r.conv_id: r for r in chat.read_back(cut).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in talk():
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(found) == set(by)
    key = spark.createDataFrame([(t[2], t[3]) for v in by.values() for t in v], "r string, t string")
    hashes = {(r.r, r.t): r.h for r in key.selectExpr("r", "t", "xxhash64(t) AS h").collect()}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[:3], hashes[t[2:]]))
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        got = found[conv]
        assert (got.n_turns, got.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (got.loss_chars, got.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    one = cut.filter("conv_id = 1").collect()
    assert len(one) > 5 and all(w.formatted.startswith("<turn system>\nbe kind</turn>\n") for w in one)
    assert any(w.repeated > 1 for w in one) and sum(len(w.formatted) for w in one) == found[1].formatted_chars
    counted = cut.select(F.regexp_count("formatted", F.lit(r"<turn ")).alias("n"), "conv_id",
                         F.regexp_count("formatted", F.lit(chat.TOKEN)).alias("tokens"))
    assert counted.filter("conv_id = 1 AND n > 3 AND tokens > 400").count() == 0
    assert chat.read_back(chat.windows(df.filter("turn > 999"))).count() == 0


def test_beginnings_must_mark_more_than_their_commonest_longer_entry():
    """Texts with "loser" do not make "los" hostile; a stem with many endings stays."""
    endings = [f"achlich{tail}" for tail in ("a", "b", "c", "d", "e")]
    seen = [("=loser", 20, 0), ("los", 21, 15), ("lose", 20, 0), ("achlich", 20, 1)]
    seen += [("=" + word, 4, 0) for word in endings]
    counts = pd.DataFrame(seen, columns=["entry", "toxic0", "clean0"])
    stems = toxicity._stems(counts, 100, 1000, (0,))
    assert {"=loser", "achlich", *("=" + word for word in endings)} <= stems.keys()
    assert not {"los", "lose"} & stems.keys()


def test_toxicity(spark, empty):
    rng = np.random.default_rng(6)
    stems = ["zorgl", "vrakk"]

    def text(toxic):
        words = list(rng.choice(WORDS, size=30))
        for _ in range(3 if toxic else 0):
            words.insert(int(rng.integers(0, 30)), str(rng.choice(stems)) + str(rng.choice(["a", "en", "ou"])))
        return " ".join(words)

    table = [(k, text(k % 4 == 0), int(k % 4 == 0)) for k in range(600)]
    docs = spark.createDataFrame(table + [(None, None, 0), (9999, "", 0)], "doc_id long, text string, score int")
    labels = docs.selectExpr("doc_id", "score AS toxic").union(docs.selectExpr("doc_id", "CAST(NULL AS INT)"))
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    found = toxicity.score(docs.select("doc_id", "text"), model).collect()
    held = [r for r in found if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    truth = {k: toxic for k, _, toxic in table} | {9999: 0}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert len(found) == 602 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    again = docs.select("doc_id", "text").union(docs.selectExpr("doc_id", "concat(text, ' zorglou') AS text"))
    repeated = toxicity.fit(again, labels)
    assert repeated.stems == model.stems and repeated.weights == pytest.approx(model.weights)
    none = toxicity.fit(empty, labels.filter("doc_id < 0"))
    assert toxicity.score(docs, none).columns == ["doc_id", "text", "score", "predicted"]
    assert toxicity.score(empty, none).count() == 0


def test_the_grammar_scores_clauses():
    grammar = toxicity.Grammar({"=idiot": 1.0})
    full = lambda text: grammar.features(text)[:2]
    assert full("a fine day, idiot") == pytest.approx([np.log1p(1.0), 0])
    assert full("you are an idiot") == pytest.approx([np.log1p(1.25), 0])
    assert full("he is not an idiot")[0] == 0 and full("he is not an idiot")[1] > 0
    assert full("she said he is an idiot")[0] == 0
    assert grammar.features("they will kill you")[4] == 1
    assert full("idiotic days") == [0, 0]


def test_the_grammar_reads_persons_speech_and_threats():
    grammar = toxicity.Grammar({"=idiot": 1.0})
    full = lambda text: grammar.features(text)[0]
    less = lambda text: grammar.features(text)[1]
    threats = lambda text: grammar.features(text)[4]
    assert full("they will kill the lights") == threats("they will kill the lights") == 0
    assert threats("kill them all") == threats("I will kill you") == threats("we should all burn them") == 1
    assert threats("they kill people in that film") == threats("kill, then they left") == 0
    for said in ("he said: you are an idiot", "she said, you are an idiot", "\"you are an idiot\" it read"):
        assert full(said) == 0 and less(said) > 0
    assert full("he left. you are an idiot") > full("an idiot") and less("he said so. you are an idiot") == 0
    assert full("an idiot you are") > full("an idiot") and full("an idiot, you see") == full("an idiot")
    assert less("you are not, idiot") == 0 < less("you are not an idiot")


@pytest.mark.parametrize("between", [5, 1000, 200_000])
def test_clauses_have_any_length(between):
    grammar = toxicity.Grammar({"=idiot": 1.0})
    text = "he said " + "word " * between + "you idiot"
    assert grammar.features(text)[:2] == pytest.approx([0, np.log1p(1.25 / 2)])
    assert grammar.features(text.replace("said", "left"))[:2] == pytest.approx([np.log1p(1.25), 0])


def plain_cascade(words, weights):
    """The same grammar as rules over all words of a clause at once."""
    kinds = [toxicity._fixed_classes().get(w, "WORD") if w not in weights else "INSULT" for w in words]
    heavy = {}
    for k, kind in enumerate(kinds):
        back = lambda n: [x for x in reversed(kinds[max(0, k - n) : k])]  # noqa: B023, E731

        def seen(name, n):
            for other in back(n):  # noqa: B023
                if other == "BREAK":
                    return False
                if other == name:
                    return True
            return False

        if kind == "INSULT":
            heavy[k] = weights[words[k]] * (1.25 if seen("PERSON", 5) else 1.0)
    return heavy


def test_insults_and_targets_equal_plain_rules():
    rng = np.random.default_rng(11)
    weights = {"=idiot": 1.0, "=scum": 3.0}
    grammar = toxicity.Grammar(weights)
    vocabulary = ["idiot", "scum", "you", "the", "day", "walks", "quickly", ",", "red"]
    for _ in range(300):
        words = [str(w) for w in rng.choice(vocabulary, size=rng.integers(1, 14))]
        symbols = iter([grammar.symbol(w) for w in words])
        found = list(toxicity.CASCADE[0].read(symbols))
        want = plain_cascade([w if w != "," else "," for w in words], {k[1:]: v for k, v in weights.items()})
        # A person keeps waiting for an insult: one insult does not end it.
        assert {k: w for k, (_, w) in enumerate(found) if w} == pytest.approx(want)


@pytest.fixture(scope="module")
def multi():
    raw = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=raw, special_tokens={})
    rank = {token.decode("latin-1"): value for token, value in raw.items()}
    return library, bpe.Backtracker(rank, bpe.reachable(rank))


def resident():
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * 4096 / 1e6


def test_bpe_of_long_pieces(multi):
    library, encoder = multi
    rng = np.random.default_rng(4)
    for size in (1, 7, 900, 1024, 1025, 5000, 70_000):
        piece = "".join(rng.choice(list("etaoinshrdlué日z"), size=size))
        raw = piece.encode()
        assert list(encoder.encode(raw.decode("latin-1"))) == library._encode_bytes(raw)
    for window in (0, 300):  # windows that cut matches short everywhere
        encoder.window = max(2 * encoder.widest, window)
        assert list(encoder.encode(raw.decode("latin-1"))) == library._encode_bytes(raw)
    before = resident()
    long = "".join(rng.choice(list("etaoinshrdlu"), size=200_000)) * 20
    ids = encoder.encode(long)
    assert "".join(encoder.spelled[x] for x in ids) == long and resident() - before < 200


def test_documents_with_very_many_or_long_pieces(spark, multi):
    library, _ = multi
    words = " ".join(str(k) for k in range(80_000)) + " " + "etaoin" * 3000 + " x" * 70_000
    frame = spark.createDataFrame([(1, words), (2, "a" * 100), (3, None)], "doc_id long, text string")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.encode_documents(frame, ranks, public_tokenizers.PATTERN).collect()
    for row, text in zip(sorted(found, key=lambda r: r.doc_id), (words, "a" * 100, "")):
        assert np.frombuffer(row.tokens, dtype="<u4").tolist() == library.encode_ordinary(text)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    few, many = (
        {r.doc_id: (r.n_pretokens, r.n_tokens) for r in token_counts.count_tokens(
            frame, ranks, public_tokenizers.PATTERN, nodes=nodes).collect()}
        for nodes in (50, 1_000_000)
    )
    assert few == many and few[3] == (0, 0) and few[1][0] > 150_000


def test_long_words_are_scored_like_short_ones():
    scores = token_counts.zipf_scores(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    trie = token_counts.ForwardTrie(scores)
    rng = np.random.default_rng(9)
    for size in (1, 2, 60, 700, 5000):
        word = "".join(rng.choice(list("etaoinshrdlu é日"), size=size)).encode()
        assert trie.count_long(word) == trie.count(word)
    before = resident()
    assert trie.count_long(b"etaoinshrdlu" * 100_000) > 100_000 and resident() - before < 60
