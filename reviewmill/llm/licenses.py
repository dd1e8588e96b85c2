"""License recognition by sentences: known sentences become identifiers, identifier sequences match rules.

Everything here is column expressions. A text is cut into sentences twice: at sentence ends and blank lines
(also of comments) with single line breaks as spaces, and at sentence ends and all line breaks; either sequence of
identifiers may match a rule. Sentences are compared in lower case as words with single spaces; known ones
are written as the cut leaves them, so a notice that runs across a colon or semicolon is two of them. After
an SPDX mark the next piece is read as an expression of license names. Rules are tried in order.

Defined results: each row is judged by itself, so repeated rows have equal results; a very long text is cut like any
other; ties cannot arise, as the first rule that fits decides.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licenses and of references to them, in normal form.
SENTENCES = {
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "this project is licensed under the mit license": "MITref",
    "spdx license identifier": "SPDX",
    "spdx license identifier mit": "MITref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITgrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITnotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITwarranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MITliability",
    "licensed under the apache license version 2 0": "Apache2ref",
    "licensed under the apache license version 2 0 the license": "Apache2ref",
    "spdx license identifier apache 2 0": "Apache2ref",
    "you may not use this file except in compliance with the license": "Apache2comply",
    "you may obtain a copy of the license at": "Apache2copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "Apache2warranty",
    "see the license for the specific language governing permissions and limitations under the license": "Apache2see",
    "this work is licensed under the gnu general public license version 3": "GPL3ref",
    "spdx license identifier gpl 3 0 only": "GPL3ref",
    "spdx license identifier gpl 2 0 only": "GPL2ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2plus",
    "this program is free software": "GPLfree",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "GPLgrant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3plus",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2plus",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LGPL3plus",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "LGPL21plus",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "LGPLgrant",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "AGPL3plus",
    "either version 3 of the license or at your option any later version": "Version3plus",
    "either version 2 1 of the license or at your option any later version": "Version21plus",
    "either version 2 of the license or at your option any later version": "Version2plus",
    "this program is distributed in the hope that it will be useful but without any warranty": "GPLwarranty",
    "this library is distributed in the hope that it will be useful but without any warranty": "GPLwarranty",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "GPLimplied",
    "see the gnu lesser general public license for more details": "LGPLsee",
    "see the gnu affero general public license for more details": "AGPLsee",
    "you should have received a copy of the gnu general public license along with this program if not see https www gnu org licenses": "GPLcopy",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLwarranty",
    "see the gnu general public license for more details": "GPLsee",
    "you should have received a copy of the gnu general public license along with this program": "GPLcopy",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDgrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDendorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSDwarranty",
    "spdx license identifier bsd 3 clause": "BSD3ref",
    "spdx license identifier bsd 2 clause": "BSD2ref",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL2ref",
    "this source code form is subject to the terms of the mozilla public license v": "MPL2ref",
    "spdx license identifier mpl 2 0": "MPL2ref",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "EPL2ref",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v2 0": "EPL2ref",
    "all rights reserved this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html": "EPL1ref",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html": "EPL1ref",
    "distributed under the boost software license version 1 0": "BSL1ref",
    "use modification and distribution are subject to the boost software license version 1 0": "BSL1ref",
    "boost software license version 1 0 august 17th 2003": "BSL1ref",
    "you can redistribute it and or modify it under the terms of the artistic license 2 0": "Artistic2ref",
    "this software is provided as is without any express or implied warranty": "ZlibWarranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZlibGrant",
    "python software foundation license version 2": "PSF2ref",
    "licensed to psf under a contributor agreement": "PSF2ref",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "CC0dedication",
    "this work is dedicated to the public domain under the cc0 1 0 universal license": "CC0dedication",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCgrant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "ZeroBSDgrant",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "licensed under cc by nc 4 0": "CCBYNC4ref",
    "licensed under cc by sa 4 0": "CCBYSA4ref",
    "licensed under cc by 4 0": "CCBY4ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4ref",
    "all rights reserved": "AllRights",
}
# Identifiers that follow each other (what lies between is no known sentence), and the license they mean.
RULES = (
    (("MITgrant", "MITnotice", "MITwarranty", "MITliability"), "MIT"),
    (("MITgrant", "MITnotice"), "MIT"),
    (("BSDgrant", "BSDsource", "BSDbinary", "BSDendorse"), "BSD-3-Clause"),
    (("BSDgrant", "BSDsource", "BSDbinary"), "BSD-2-Clause"),
    (("LGPLgrant", "Version3plus"), "LGPL-3.0-or-later"),
    (("LGPLgrant", "Version21plus"), "LGPL-2.1-or-later"),
    (("GPLgrant", "Version3plus"), "GPL-3.0-or-later"),
    (("GPLgrant", "Version2plus"), "GPL-2.0-or-later"),
    (("GPL3plus", "GPLwarranty", "GPLsee"), "GPL-3.0-or-later"),
    (("GPL2plus", "GPLwarranty", "GPLsee"), "GPL-2.0-or-later"),
    (("Apache2ref", "Apache2comply", "Apache2copy"), "Apache-2.0"),
    (("LGPL3plus",), "LGPL-3.0-or-later"),
    (("LGPL21plus",), "LGPL-2.1-or-later"),
    (("AGPL3plus",), "AGPL-3.0-or-later"),
    (("GPL3plus",), "GPL-3.0-or-later"),
    (("GPL2plus",), "GPL-2.0-or-later"),
    (("GPL3ref",), "GPL-3.0-only"),
    (("GPL2ref",), "GPL-2.0-only"),
    (("MPL2ref",), "MPL-2.0"),
    (("EPL2ref",), "EPL-2.0"),
    (("EPL1ref",), "EPL-1.0"),
    (("BSL1ref",), "BSL-1.0"),
    (("Artistic2ref",), "Artistic-2.0"),
    (("ZlibWarranty", "ZlibGrant"), "Zlib"),
    (("ZlibGrant",), "Zlib"),
    (("PSF2ref",), "PSF-2.0"),
    (("CC0dedication",), "CC0-1.0"),
    (("Apache2ref",), "Apache-2.0"),
    (("BSD3ref",), "BSD-3-Clause"),
    (("BSD2ref",), "BSD-2-Clause"),
    (("MITref",), "MIT"),
    (("ISCgrant",), "ISC"),
    (("ZeroBSDgrant",), "0BSD"),
    (("Unlicense",), "Unlicense"),
    (("CCBYNC4ref",), "CC-BY-NC-4.0"),
    (("CCBYSA4ref",), "CC-BY-SA-4.0"),
    (("CCBY4ref",), "CC-BY-4.0"),
    (("AllRights",), "Proprietary"),
)
# Names of licenses and of exceptions in SPDX expressions.
NAMES = (
    "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause",
    "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0", "GPL-2.0-only",
    "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0", "PSF-2.0", "Python-2.0", "Unlicense", "WTFPL", "Zlib",
    "Classpath-exception-2.0", "GCC-exception-3.1", "LLVM-exception", "Linux-syscall-note",
)
# Each known sentence holds one of these; a text with none of them needs no closer look.
ANCHORS = ("licens", "permi", "copyright", "warrant", "liab", "redistribut", "free", "rights")

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SENTENCE_END = r"[.!?:;]+([ \t\r\n]|\z)"
# Two line breaks or more with nothing but signs of a comment between them.
BLANK_LINES = r"(\r?\n[ \t]*(#+|//+|\*+|--+|;+)?[ \t]*){2,}"
UNKNOWN, SPDX = "unknown", "spdx license identifier"


def _plain_name(name: str) -> str:
    """A name as the cut leaves it; the word in "or later" is no operator."""
    return re.sub("[^a-z0-9]+", " ", name.lower()).replace(" or later", " orlater")


NAME_OF = {_plain_name(name): name for name in NAMES}


def _expression(piece: Column) -> Column:
    """An SPDX expression from the piece after the mark; null if it has a name that is not known."""
    apart = F.split(F.regexp_replace(F.replace(piece, F.lit(" or later"), F.lit(" orlater")), " (or|and|with) ", "\t$1\t"), "\t")
    names = F.create_map(*[F.lit(x) for pair in NAME_OF.items() for x in pair])
    parts = F.transform(apart, lambda t: F.when(t.isin("or", "and", "with"), F.upper(t)).otherwise(F.element_at(names, t)))
    return F.when(~F.exists(parts, lambda p: p.isNull()), F.concat(F.lit("="), F.array_join(parts, " ")))


def _pieces(text: Column, lines: bool) -> Column:
    """The sentences of a text in normal form."""
    if not lines:
        text = F.regexp_replace(F.regexp_replace(text, BLANK_LINES, "\x02"), r"[\r\n]", " ")
    marked = F.regexp_replace(F.translate(text, CAPITALS, SMALL), SENTENCE_END + "|\x02", "\n")
    return F.transform(F.split(F.regexp_replace(marked, "[^a-z0-9\n]+", " "), "\n"), lambda s: F.trim(s))


def _identifiers(pieces: str) -> Column:
    """Identifiers of the known sentences in order, between commas; null where there is none."""
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    # A license name counts only behind the mark.
    found = F.zip_with(
        pieces, F.concat(F.array(F.lit("")), pieces), lambda piece, before: F.when(before == SPDX, _expression(piece)).otherwise(F.element_at(known, piece))
    )
    joined = F.concat(F.lit(","), F.array_join(F.filter(found, lambda i: i.isNotNull()), ","), F.lit(","))
    return F.nullif(joined, F.lit(",,"))


def recognize(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, by_text, by_line, license``.

    ``by_text`` and ``by_line`` are the identifiers of the two ways to cut, null without any. ``license`` is the first
    SPDX expression, else that of the first rule whose identifiers stand next to each other in one of the
    sequences, ``unknown`` where identifiers match no rule, null without identifiers (so for null and empty texts).
    """
    folded = F.lower("text")
    worth = F.lit(False)
    for anchor in ANCHORS:
        worth = worth | folded.contains(anchor)
    looked = docs.select("doc_id", F.when(worth, F.col("text")).alias("text"))
    pieces = looked.select("doc_id", _pieces(F.col("text"), False).alias("in_text"), _pieces(F.col("text"), True).alias("in_lines"))
    sequences = pieces.select("doc_id", _identifiers("in_text").alias("by_text"), _identifiers("in_lines").alias("by_line"))
    any_found = F.col("by_text").isNotNull() | F.col("by_line").isNotNull()
    license_name = F.when(any_found, F.lit(UNKNOWN))
    for identifiers, name in reversed(RULES):
        needle = "," + ",".join(identifiers) + ","
        hit = F.coalesce(F.col("by_text").contains(needle), F.lit(False)) | F.coalesce(F.col("by_line").contains(needle), F.lit(False))
        license_name = F.when(hit, F.lit(name)).otherwise(license_name)
    stated = [F.nullif(F.regexp_extract(c, ",=([^,]+),", 1), F.lit("")) for c in ("by_line", "by_text")]
    return sequences.withColumn("license", F.coalesce(*stated, license_name))


def recognize_sql(documents: str = "documents") -> str:
    """The same in the SQL dialect the tests compare with."""
    names = ", ".join(f"'{k}': '{v}'" for k, v in NAME_OF.items())
    known = ", ".join(f"'{s}': '{i}'" for s, i in SENTENCES.items())

    def sequence(lines: bool) -> str:
        text = "text" if lines else rf"regexp_replace(regexp_replace(text, '{BLANK_LINES}', chr(2), 'g'), '[\r\n]', ' ', 'g')"
        marked = rf"regexp_replace(translate({text}, '{CAPITALS}', '{SMALL}'), '{SENTENCE_END}|\x02', chr(10), 'g')"
        return rf"list_transform(string_split(regexp_replace({marked}, '[^a-z0-9\n]+', ' ', 'g'), chr(10)), lambda s: trim(s))"

    def identifiers(pieces: str) -> str:
        apart = rf"string_split(regexp_replace(replace(p, ' or later', ' orlater'), ' (or|and|with) ', chr(9) || '\1' || chr(9), 'g'), chr(9))"
        parts = f"list_transform({apart}, lambda t: CASE WHEN t IN ('or', 'and', 'with') THEN upper(t) ELSE (MAP {{{names}}})[t] END)"
        stated = f"CASE WHEN len(list_filter({parts}, lambda x: x IS NULL)) = 0 THEN '=' || array_to_string({parts}, ' ') END"
        one = f"CASE WHEN i > 1 AND {pieces}[i - 1] = '{SPDX}' THEN {stated} ELSE (MAP {{{known}}})[p] END"
        found = f"list_filter(list_transform({pieces}, lambda p, i: {one}), lambda x: x IS NOT NULL)"
        return f"nullif(',' || array_to_string({found}, ',') || ',', ',,')"

    cases = "\n".join(
        f"WHEN contains(coalesce(by_text, ''), ',{','.join(i)},') OR contains(coalesce(by_line, ''), ',{','.join(i)},') THEN '{n}'"
        for i, n in RULES
    )
    return f"""WITH pieces AS (
  SELECT doc_id, {sequence(False)} AS in_text, {sequence(True)} AS in_lines FROM {documents}),
sequences AS (
  SELECT doc_id, {identifiers('in_text')} AS by_text, {identifiers('in_lines')} AS by_line FROM pieces)
SELECT doc_id, by_text, by_line, coalesce(
  nullif(regexp_extract(by_line, ',=([^,]+),', 1), ''), nullif(regexp_extract(by_text, ',=([^,]+),', 1), ''), CASE {cases}
  WHEN by_text IS NOT NULL OR by_line IS NOT NULL THEN '{UNKNOWN}' END) AS license
FROM sequences"""
