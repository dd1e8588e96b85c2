"""Every operator on a small table with awkward rows, against brute force."""

from __future__ import annotations

import datetime
import itertools
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from edge import BASE, DOCS, documents, edited, empty, prose

from reviewmill.llm import (
    chat,
    decontaminate,
    embedding_dup,
    language_model,
    licenses,
    near_dup,
    packing,
    pseudonyms,
    quality,
    token_files,
    tokens,
)
from reviewmill.session import scratch_path

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def whole(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


# 1


def test_license_sentences_and_rules(spark):
    grant = next(s for s, i in licenses.SENTENCES.items() if i == "MITgrant")
    notice = next(s for s, i in licenses.SENTENCES.items() if i == "MITnotice")
    rows = [
        (1, "Some text\nReleased under the MIT License."),
        (2, "Licensed under the Apache License, Version 2.0."),
        (3, f"{grant.upper()}:\n\nSomething else. The above copyright notice\n {notice[27:]}."),
        (4, "We talk about a license."),
        (5, None),
        (6, ""),
        (7, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
        (8, "x " * 100_000 + ". All rights reserved"),
        (8, "x " * 100_000 + ". All rights reserved"),
    ]
    found = licenses.recognize(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.license or "") for r in found) == [
        (1, "MIT"), (2, "Apache-2.0"), (3, "MIT"), (4, ""), (5, ""), (6, ""), (7, "unknown"), (8, "Proprietary"), (8, "Proprietary"),
    ]
    assert licenses.recognize(empty(spark)).count() == 0
    assert all(any(a in s for a in licenses.ANCHORS) for s in licenses.SENTENCES)


MIT_FILE = """MIT License

Copyright (c) 2020 A. Person

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
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
GNU = """ * {what} is free software: you can redistribute it and/or modify
 * it under the terms of the GNU {name} as published by
 * the Free Software Foundation{sign} either version {version} of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU {name} for more details.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty.  In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""
GPL, LGPL, AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
NOTICES = {
    "MIT": MIT_FILE,
    "Apache-2.0": APACHE,
    "GPL-3.0-or-later": GNU.format(what="This program", name=GPL, sign=",", version="3"),
    "GPL-2.0-or-later": GNU.format(what="This program", name=GPL, sign=";", version="2"),
    "LGPL-3.0-or-later": GNU.format(what="This program", name=LGPL, sign=",", version="3"),
    "LGPL-2.1-or-later": GNU.format(what="This library", name=LGPL, sign=";", version="2.1"),
    "AGPL-3.0-or-later": GNU.format(what="This program", name=AGPL, sign=",", version="3"),
    "MPL-2.0": MPL,
    "BSD-2-Clause": BSD,
    "BSD-3-Clause": BSD + ENDORSE,
    "ISC": ISC,
    "0BSD": ISC.replace(", provided that the above\ncopyright notice and this permission notice appear in all copies", ""),
    "Zlib": ZLIB,
    "BSL-1.0": "// Distributed under the Boost Software License, Version 1.0.\n// (See accompanying file LICENSE_1_0.txt)",
    "Artistic-2.0": "This is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0.",
    "CC0-1.0": "SPDX-License-Identifier: CC0-1.0",
    "Apache-2.0 OR MIT": "// SPDX-License-Identifier: (Apache-2.0 OR MIT)\nfn main() {}",
    "GPL-2.0-or-later WITH Classpath-exception-2.0": "/* SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 */",
    "EPL-2.0": "SPDX-License-Identifier: EPL-2.0\nCopyright 2020 A. Person. All rights reserved.",
}


def test_verbatim_notices_give_their_license(spark, tmp_path):
    import duckdb

    rows = [(i, f"Some words before.\n\n{notice}\nint x;") for i, notice in enumerate(NOTICES.values())]
    rows += [(100, "Er kam mit. MIT. ISC."), (101, "SPDX-License-Identifier: Something-1.0"), (102, " ".join(["Permission?"] * 40_000)), (103, rows[0][1])]
    frame = documents(spark, rows)
    found = {r.doc_id: r for r in licenses.recognize(frame).collect()}
    assert {name: found[i].license for i, name in enumerate(NOTICES)} == {name: name for name in NOTICES}
    assert (found[100].license, found[101].license, found[102].license, found[103].license) == (None, "unknown", None, "MIT")
    frame.write.parquet(str(tmp_path / "docs"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/docs/*.parquet')")
    assert sorted(con.sql(licenses.recognize_sql()).fetchall()) == sorted((r.doc_id, r.by_text, r.by_line, r.license) for r in found.values())


# 2


def brute_links(rows, threshold):
    links, units = {}, []
    for vec_id, vector, label in rows:
        good = vector is not None and label is not None and vec_id is not None and len(vector) and None not in vector
        v = np.array(vector, dtype=float) if good else np.zeros(1)
        units.append((label, v / np.linalg.norm(v)) if good and np.isfinite(v).all() and v.any() else None)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if units[a] and units[b] and units[a][0] == units[b][0] and len(units[a][1]) == len(units[b][1]) and units[a][1] @ units[b][1] >= threshold:
            links.setdefault(a, set()).add(b)
            links.setdefault(b, set()).add(a)
    return links


def test_vectors_with_large_and_small_groups(spark):
    draw, rows = np.random.default_rng(3), []
    centre = draw.standard_normal(16)
    for i in range(150):
        rows.append((i, (centre + 0.25 * draw.standard_normal(16)).tolist(), 1))
    for i in range(150, 200):
        rows.append((i, draw.standard_normal(16).tolist(), i % 3))
    same = draw.standard_normal(16).tolist()
    rows += [(i, same, 2) for i in range(200, 230)] + [(230, same, None), (231, None, 1), (232, [0.0] * 16, 1)]
    rows += [(233, [math.nan] * 16, 1), (234, [None] * 16, 1), (235, [math.inf] * 16, 1), (236, same[:8], 2), (237, [], 2), (None, same, 2)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, unit string").repartition(3)
    settings = embedding_dup.Settings(window=16, block=32)
    found = {r.vec_id: r for r in embedding_dup.near_vectors(frame, settings).collect()}
    links = brute_links(rows, 0.93)
    assert len(found) == len(rows)
    for i, (vec_id, _, _) in enumerate(rows):
        assert found[vec_id].n_links == len(links.get(i, ())), vec_id
    component = {i: i for i in range(len(rows))}
    for _ in range(len(rows)):
        for a, others in links.items():
            component[a] = min([component[a], *(component[b] for b in others)])
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            assert found[vec_id].component_id == rows[component[i]][0]
            assert found[vec_id].kept == (component[i] == i)
    assert embedding_dup.near_vectors(frame.limit(0)).count() == 0


def test_pairs_in_a_dense_label(spark):
    """Vectors that all point one way, with pairs among them: more vectors than any window holds."""
    draw, size = np.random.default_rng(8), 32
    crowd = np.sqrt(0.85) * np.eye(size)[0] + np.sqrt(0.15 / size) * draw.standard_normal((4000, size))
    twins = crowd[:200] + 0.02 * draw.standard_normal((200, size))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([crowd, twins]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    settings = embedding_dup.Settings(threshold=0.985, window=32, block=128)
    found = {r.vec_id: r for r in embedding_dup.near_vectors(frame, settings).collect()}
    units = np.array([r[1] for r in rows])
    units /= np.linalg.norm(units, axis=1)[:, None]
    near = units @ units.T >= 0.985
    np.fill_diagonal(near, False)
    assert near[:200, 4000:].diagonal().all()
    links = near.sum(axis=1)
    assert sum(found[i].n_links == links[i] for i in range(len(rows))) >= 0.99 * len(rows)
    assert sum(found[4000 + i].component_id == found[i].component_id for i in range(200)) >= 198


# 3


def test_token_files_round_trip(spark):
    path, encode = scratch_path(spark, "files"), whole(WORD)
    token_files.write_token_files(documents(spark), path, WORD, tokens.split_at_space, end_id=2)
    found = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    expected = sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r.doc_id for r in found] == [i for i, _ in expected]
    start = 0
    for row, (_, text) in zip(found, expected):
        ids = encode(text) + [2]
        assert (row.start, row.n_tokens, np.frombuffer(row.ids, "<u4").tolist()) == (start, len(ids), ids)
        start += len(ids)


def test_token_files_of_an_empty_table(spark):
    path = scratch_path(spark, "files")
    token_files.write_token_files(empty(spark), path, WORD, tokens.split_at_space, end_id=2)
    assert token_files.read_token_files(spark, path).count() == 0


# 4


def test_conversations_come_back_and_share_their_turns(spark):
    control = "</s>[INST] ok [/INST] <|turn|>x<|text|>\\<|end|>\\"
    rows = [(c, t, role, text) for c in range(40) for t, role, text in ((0, "system", "be good"), (1, "user", f"q{c % 4}"), (2, "assistant", f"a{c}"))]
    rows += [(-1, 0, "user", control), (-1, 1, "assistant", control), (50, 0, "assistant", None), (51, None, None, ""), (None, 0, "user", "x"), (None, 1, "assistant", "y")]
    rows += [(52, 0, "assistant", "b"), (52, 0, "assistant", "a"), (53, 0, "user", "long " * 50_000)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, path int").repartition(4)
    blocks = chat.prefix_blocks(frame)
    every = chat.read_blocks(blocks).collect()
    # Rows without an id are conversations of one turn.
    assert sorted([(t["role"], t["text"]) for t in r.turns] for r in every if r.conv_id is None) == [[("assistant", "y")], [("user", "x")]]
    found = {r.conv_id: r for r in every if r.conv_id is not None}
    expected = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected.setdefault(c, []).append((role or "", text or ""))
    assert len(every) == len(expected) + 2
    assert {c: [(t["role"], t["text"]) for t in r.turns] for c, r in found.items()} == expected
    for c, turns in expected.items():
        assert found[c].loss == [t for role, t in turns if role == "assistant"]
        assert found[c].formatted == "".join(chat.rendered(*t) for t in turns)
    rows_of = blocks.collect()
    # Shared turns stand once in a block, and ancestors are all a turn may attend to.
    assert sum(len(b.nodes) for b in rows_of) < sum(map(len, expected.values()))
    for block in rows_of:
        assert len(set(zip([n.start for n in block.nodes]))) == len(block.nodes)
        for conversation in block.conversations:
            nodes = [block.nodes[n] for n in conversation.nodes]
            for depth, node in enumerate(nodes):
                assert node.position == sum(n.length for n in nodes[:depth])
                ancestors = [i for n in nodes[:depth] for i in range(n.start, n.start + n.length)]
                assert [i for a in node.attend for i in range(a.start, a.end)] == ancestors
                assert all(a.end < b.start for a, b in zip(node.attend, node.attend[1:]))
                if node.loss_start is not None:
                    masked = block.text[node.loss_start : node.loss_start + node.loss_length]
                    assert block.text[node.start : node.start + node.length].endswith(masked + chat.END)
    small = chat.prefix_blocks(frame, block_chars=200)
    assert small.count() > blocks.count() and chat.read_blocks(small).count() == len(every)
    assert chat.read_blocks(chat.prefix_blocks(frame.limit(0))).count() == 0


def test_very_long_conversations_and_many_rows_without_an_id(spark):
    turns = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, null, if(id % 3 = 1, 1L, 2L)) AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
        "if(id < 30000, 'shared', concat('text ', id)) AS text",
    )
    sizes = sorted((r.conv_id or 0, len(r.turns)) for r in chat.read_blocks(chat.prefix_blocks(turns)).collect())
    assert sizes == [(0, 1)] * 20_000 + [(1, 20_000), (2, 20_000)]


def test_chat_tokens(spark):
    frame = spark.createDataFrame([(1, 0, "user", "hello"), (1, 1, "assistant", "there"), (2, 0, "user", "hello")], "conv_id long, turn int, role string, text string")
    (block,) = chat.prefix_blocks(frame.coalesce(1), encode=lambda text: [ord(c) for c in text]).collect()
    assert "".join(map(chr, block.tokens)) == block.text and len(block.nodes) == 2


# 5


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_junk_goes_and_good_texts_stay(spark):
    rows = [(i, prose(i + 100, 60)) for i in range(400)]
    rows += [(i, " ".join(w + "###" for w in prose(i + 100, 60).split())) for i in range(400, 480)]
    rows += [(i, prose(i + 100, 50) + " vile nasty. " + prose(i, 8) + " nasty") for i in range(480, 560)]
    rows += [(600, None), (601, ""), (602, prose(1, 30)), (602, prose(1, 30)), (None, prose(2, 30))]
    labels = labelled(spark, [(i, int(i < 400 or i >= 480), int(i >= 480)) for i in range(0, 560, 2)] + [(None, 1, 0), (601, None, None)])
    found = quality.resample(documents(spark, rows), labels).collect()
    assert len(found) == len(rows)
    kept = {r.doc_id for r in found if r.kept}
    assert len(kept & set(range(400))) >= 392
    assert len(kept & set(range(400, 560))) <= 4
    assert not kept & {600, 601} and len({r.kept for r in found if r.doc_id == 602}) == 1
    sampled = quality.sample(documents(spark, rows), labels)
    assert sampled.columns == documents(spark, rows).columns
    assert {r.doc_id for r in sampled.collect()} == kept


def test_resampling_without_labels_or_documents(spark):
    found = quality.resample(documents(spark), labelled(spark, [])).collect()
    assert all(r.kept == (r.log_weight is not None) for r in found) and len(found) == len(DOCS)
    assert quality.resample(empty(spark), labelled(spark, [(1, 1, 0)])).count() == 0
    assert quality.sample(empty(spark), labelled(spark, [])).count() == 0


def test_kth_largest(spark):
    values = [5, -3, 7, 7, 1 << 40, -(1 << 50), 0]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    for k in range(1, len(values) + 1):
        assert quality._kth_largest(frame, "v", k) == sorted(values, reverse=True)[k - 1]


def test_log_ratios():
    n, target = np.array([100, 100, 100, 100, 0]), np.array([30, 30, 0, 30, 0])
    ratio = quality.log_ratios(n, target, 3.0, 2.0)
    assert ratio[0] == ratio[4] == 0 and ratio[2] == pytest.approx(math.log(3 / 30), rel=1e-6)


# 6


def levenshtein_in(passage: str, text: str) -> int:
    """Fewest edits of the passage against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def plain(text: str) -> str:
    import re

    return re.sub(r"[^a-z0-9\x80-\U0010ffff]+", " ", (text or "").lower())


def test_passages_with_edits(spark):
    passages = [(1, prose(201, 25)), (2, prose(202, 12)), (3, "tiny"), (4, None), (5, ""), (6, "exactly so much"), (6, "exactly so much")]
    first, second = passages[0][1], passages[1][1]
    rows = [
        (1, prose(11, 80) + " " + first + " " + prose(12, 50)),
        (2, prose(13, 50) + "\n" + first.upper().replace(" ", ",  ") + "."),
        (3, prose(14, 30) + first[:30] + "XX" + first[33:70] + first[72:] + prose(15, 5)),
        (4, first[40:]),
        (5, prose(16, 300) + second),
        (6, second[:40] + "zzzzzzzzzzzzzzzzzz" + second[40:]),
        (7, None),
        (8, ""),
        (9, "we need exactly so much of it"),
        (10, prose(17, 20_000) + " " + first),
        (11, second),
        (11, second),
        (None, second),
    ]
    docs, bench = documents(spark, rows), spark.createDataFrame(passages, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.find_passages(docs, bench).collect()}
    expected = {}
    for doc, text in rows:
        for item, passage in passages:
            trimmed = plain(passage).strip()
            if len(trimmed) < 8 or (doc == 10 and item != 1):
                continue
            body = plain(text) if doc != 10 else plain(text)[-400:]
            edits, budget = levenshtein_in(trimmed, body), min(len(trimmed) // 10, (len(trimmed) - 8) // 8)
            if edits <= budget:
                expected[doc, item] = edits
    assert {k: r.edits for k, r in found.items()} == expected
    assert {(3, 1), (2, 1), (5, 2), (9, 6)} <= set(found) and (6, 2) not in found and (4, 1) not in found
    row = found[5, 2]
    assert second in dict(rows)[5].encode()[row.first_byte : row.end_byte].decode()
    clean = decontaminate.decontaminate(docs, bench)
    dirty = {d for d, _ in expected}
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in rows if d not in dirty)
    by_blocks = decontaminate.find_passages(docs, bench, decontaminate.Settings(block_bytes=100)).collect()
    assert {(r.doc_id, r.item_id) for r in by_blocks} == set(expected)
    assert decontaminate.find_passages(empty(spark), bench).count() == 0
    assert decontaminate.find_passages(docs, bench.limit(0)).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(rows)


# 7


def checked_pieces(rows, docs, limits, end, prompts=None):
    encode, by_doc, by_sequence = whole(BYTE), {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    texts = Counter((i, tuple(encode(t) + end)) for i, t in docs)
    for (doc, ids), times in texts.items():
        if ids:
            pieces = [r for r in by_doc[doc, len(ids)] if list(np.frombuffer(r.ids, "<u4")) == list(ids[r.start : r.start + r.length])]
            assert Counter(p for r in pieces for p in range(r.start, r.start + r.length)) == {p: times for p in range(len(ids))}
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        size = sum(r.length for r in pieces)
        assert size <= limits.tokens and len(pieces) <= limits.segments
        loss = sum(max(0, r.start + r.length - max(r.start, (prompts or {}).get(r.doc_id, 0))) for r in pieces)
        assert loss <= limits.loss_tokens
        padding += 0 if size & (size - 1) == 0 else limits.tokens - size
    return padding, sum(r.length for r in rows)


def test_packing_fills_sequences(spark):
    rows = packing.pack(documents(spark), BYTE, end_id=0).collect()
    padding, total = checked_pieces(rows, DOCS, packing.Limits(), [0])
    assert padding == 0 and total > 60_000
    assert packing.pack(empty(spark), BYTE, end_id=0).count() == 0
    # Without an end id an empty text has no piece.
    checked_pieces(packing.pack(documents(spark), BYTE).collect(), DOCS, packing.Limits(), [])


def test_packing_under_three_limits(spark):
    docs = [(i, prose(i, 5 + i * 3 % 70)) for i in range(300)] + [(900, prose(5, 3000))]
    prompts = {i: (i * 7) % 90 for i, _ in docs}
    frame = spark.createDataFrame([(i, t, prompts[i]) for i, t in docs], "doc_id long, text string, prompt int").coalesce(2)
    limits = packing.Limits(tokens=256, segments=5, loss_tokens=128)
    rows = packing.pack(frame, BYTE, end_id=0, limits=limits, prompt_tokens="prompt").collect()
    checked_pieces(rows, docs, limits, [0], prompts)


# 8


def jaccard(a: str, b: str) -> float:
    sets = []
    for text in (a, b):
        w = plain(text).split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_duplicates_of_the_small_table(spark):
    found = [(r.doc_id, r.class_id, r.kept) for r in near_dup.near_duplicates(documents(spark)).collect()]
    classes = dict((i, c) for i, c, _ in found)
    assert len(found) == len(DOCS)
    assert classes[1] == classes[2] == classes[3] == 1 and classes[12] == 11 and classes[10] == 9
    assert jaccard(BASE, edited(BASE, [20, 60, 100, 140, 180])) < 0.8 and classes[5] == 5
    assert all(classes[i] == i for i in (6, 7, 8, 13, 14, -5)) and classes[None] is None
    assert all(kept == (i is None or i == c) for i, c, kept in found)
    left = near_dup.drop_near_duplicates(documents(spark))
    assert left.columns == documents(spark).columns
    kept = sorted({i for i, c, k in found if k and i is not None}) + [None, None]
    assert sorted((r.doc_id for r in left.collect()), key=lambda i: (i is None, i or 0)) == kept
    assert near_dup.near_duplicates(empty(spark)).count() == 0


def test_crowded_buckets_lose_no_link(spark):
    """Hundreds of half-similar variants of one text, some of which have near copies of their own."""
    base, rows = prose(77, 150), []
    draw = np.random.default_rng(5)
    for i in range(240):
        text = edited(base, sorted(draw.choice(150, int(draw.integers(0, 12)), replace=False).tolist()))
        rows.append((2 * i, text))
        if i % 6 == 0:
            rows.append((2 * i + 1, text + " added words at the end"))
    found = {r.doc_id: r.class_id for r in near_dup.near_duplicates(documents(spark, rows)).collect()}
    idf = 1.0
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in ((i, plain(t)) for i, t in rows)}
    df = Counter(s for x in sets.values() for s in x)
    weight = {s: min(2, max(1, idf + math.log((len(rows) + 1) / (n + 1)) / math.log(1 << 20))) for s, n in df.items()}
    for (a, _), (b, _) in itertools.combinations(rows, 2):
        shared = sum(weight[s] for s in sets[a] & sets[b])
        if shared / sum(weight[s] for s in sets[a] | sets[b]) >= 0.8:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert len(set(map(root, parent))) > 20
    wrong = [i for i in parent if found[i] != root(i)]
    assert len(wrong) <= 0.02 * len(rows), wrong


def test_samples_agree_as_often_as_the_weights():
    draw, settings = np.random.default_rng(1), near_dup.Settings(bands=40, rows=10)
    keys = np.sort(draw.integers(0, 1 << 48, 300).astype(np.uint64))
    weights = draw.uniform(1, 6, 300)
    other = np.where(np.arange(300) < 220, weights * draw.uniform(0.7, 1.3, 300), 0)
    kept = other > 0
    one = near_dup.samples(keys, weights, np.array([0]), settings)
    two = near_dup.samples(keys[kept], other[kept], np.array([0]), settings)
    similarity = np.minimum(weights, other).sum() / np.maximum(weights, other).sum()
    assert abs((one == two).mean() - similarity) < 0.08


# 9


def test_permutations_have_no_fixed_points():
    for size in (2, 3, 10, 97, 1000):
        permutation = pseudonyms.Permutation(b"k" * 16, "test", size)
        image = [permutation(i) for i in range(size)]
        assert sorted(image) == list(range(size)) and all(a != b for a, b in enumerate(image))


VALUES = {
    "97.51.17.173": "ip",
    "4111111111111111": "card",
    "9807915762804490": "card",
    "4111 1111 1111 1111": "card",
    "+1 (017) 555-7713": "phone",
    "9233A8ECF7C5B09FE5949719B6B82BC439E9329B": "hex",
    "2024-02-29": "date",
    "5.11.2001": "date",
    "12/31/1999": "date",
    "GB82WEST12345698765432": "iban",
    "078-05-1120": "ssn",
    "ghp_abcdefghijklmnop1234": "secret",
}
STAY = ["300.1.1.1", "31.6.2020", "078-00-1120", "GB83WEST12345698765432", "version 2.0.1", "12345", "1.2.3.4.5"]


@pytest.mark.parametrize("value", VALUES)
def test_values_keep_their_format(value):
    known = pseudonyms.Pseudonyms(b"secret" * 4)
    new, n = known.replace(f"see {value}, or {value}!!")
    assert n == 2 and value not in new
    first, second = new[4 : 4 + len(value)], new[-2 - len(value) : -2]
    assert first == second and len(first) == len(value)
    assert [c.isdigit() for c in first] == [c.isdigit() for c in value] or VALUES[value] in ("hex",)
    again = pseudonyms.PATTERN.search(first)
    assert again.lastgroup == VALUES[value] and again.group() == first
    if value.startswith("4111"):
        digits = first.replace(" ", "")
        assert pseudonyms.luhn(digits[:-1]) == int(digits[-1])
    if VALUES[value] == "ip":
        assert all(int(p) < 256 for p in first.split("."))
    if value == "2024-02-29":
        datetime.date.fromisoformat(first)
    assert pseudonyms.Pseudonyms(b"other!" * 4).replace(value)[0] != first


def test_pseudonyms_of_a_table(spark):
    rows = [(1, "mail a.68@mail7.example.com"), (2, "a.68@mail7.example.com " + "x " * 100_000), (3, None), (4, ""), (None, "a.68@mail7.example.com"), (5, " ".join(STAY))]
    frame = documents(spark, rows)
    found = {r.doc_id: r for r in pseudonyms.pseudonymize(frame, b"key" * 8, count="n_values").collect()}
    assert found[1].n_values == found[None].n_values == 1 and found[1].text[5:] == found[None].text == found[2].text[:22]
    assert found[1].text.endswith("@mail7.example.com") and "a.68" not in found[1].text
    assert found[3].text is None and found[4].text == "" and found[5].text == " ".join(STAY) and found[1].n == 7
    assert pseudonyms.pseudonymize(empty(spark), b"key" * 8).columns == frame.columns
    with pytest.raises(ValueError):
        pseudonyms.pseudonymize(frame, b"key" * 8, count="kept")


# 10


def test_language_model_against_counts(spark):
    rows = [(i, prose(i % 17, 40) + " " + prose(i, 20)) for i in range(120)] + [(500, None), (501, ""), (502, "Word" * 3000), (None, "x y"), (7, prose(7, 10))]
    held = {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 10 == 0} | {500}
    frame = spark.createDataFrame([(i, t, i in held, 1) for i, t in rows], "doc_id long, text string, held_out boolean, score int").repartition(5)
    settings = language_model.Settings(chunk_tokens=300, shard_ngrams=500)
    found = language_model.score_corpus(frame, settings).collect()
    texts = [(i, (t or "").lower().split() + ["</s>"]) for i, t in rows]
    grams = [Counter() for _ in range(3)]
    for i, t in texts:
        if i not in held:
            for n in range(3):
                grams[n].update(tuple(t[j : j + n + 1]) for j in range(len(t) - n))
    total, kinds, prior = sum(grams[0].values()), len(grams[0]), settings.prior

    def probability(gram):
        if len(gram) == 1:
            return (grams[0][gram] + 0.1) / (total + 0.1 * (kinds + 1))
        return (grams[len(gram) - 1][gram] + prior * probability(gram[1:])) / (grams[len(gram) - 2][gram[:-1]] + prior)

    expected = []
    for i, t in texts:
        base = sum(math.log10(probability((w,))) for w in t)
        score = sum(math.log10(probability(tuple(t[max(0, j - 2) : j + 1]))) for j in range(len(t)))
        expected.append((str(i), len(t), sum(grams[0][(w,)] > 0 for w in t), base, score))
    got = [(str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in found]
    for e, g in zip(sorted(expected), sorted(got), strict=True):
        assert e[:3] == g[:3] and g[3] == pytest.approx(e[3], rel=1e-9)
        assert g[4] == pytest.approx(e[4], rel=0.02), e[0]  # probabilities are quantised
    assert {r.train_tokens for r in found} == {total}
    assert language_model.score_corpus(frame.limit(0)).count() == 0
    nothing = language_model.score_corpus(frame.selectExpr("doc_id", "text", "true AS held_out")).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in nothing)


