"""Licence scans by sentence rules.

A text is cut into sentences (at line ends and after ``.``, ``!``, ``?`` before white space), and
each sentence is normalised: lower case, list marks as ``(1)`` out, anything but letters and digits,
so also comment marks, as one blank. Known sentences have identifiers. As texts are wrapped, a known
sentence may also go over several of these pieces, one after the other without a blank one
between; a holder named in it is put as in the known sentence. A licence is recognised by an ordered rule:
its identifiers must occur in the text in this order, with at most ``gap`` sentences between one
and the next. Most notices are rules of one sentence; full texts have several.

Only built-in functions: the table of sentences is a literal map, and the rules run over the few
identifiers that were found in a text, not over its sentences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import free_name, quoted, text_or_empty, without

#: Known sentences by identifier, normalised. The public wording of the licences.
SENTENCES = {
    "mit-title": "the mit license",
    "mit-title-short": "mit license",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-project": "this project is licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and"
                 " associated documentation files the software to deal in the software without restriction including"
                 " without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
                 " copies of the software and to permit persons to whom the software is furnished to do so subject to"
                 " the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or"
                  " substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not"
                    " limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-licensed": "licensed under the apache license version 2 0",
    "apache-licensed-the": "licensed under the apache license version 2 0 the license",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license"
                    " is distributed on an as is basis without warranties or conditions of any kind either express or"
                    " implied",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl3-licensed": "licensed under the gnu general public license version 3",
    "gpl2-work": "this work is licensed under the gnu general public license version 2",
    "gpl2-licensed": "licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu"
                " general public license as published by the free software foundation either version 3 of the license"
                " or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu"
                 " general public license as published by the free software foundation either version 2 of the license"
                 " or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even"
                " the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl3-licensed": "licensed under the gnu lesser general public license version 3",
    "agpl3-licensed": "licensed under the gnu affero general public license version 3",
    "mpl2-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl2-licensed": "licensed under the mozilla public license version 2 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted"
                 " provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and"
                  " the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions"
                  " and the following disclaimer in the documentation and or other materials provided with the"
                  " distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse"
                 " or promote products derived from this software without specific prior written permission",
    "bsd3-licensed": "licensed under the bsd 3 clause license",
    "bsd2-licensed": "licensed under the bsd 2 clause license",
    "isc-licensed": "licensed under the isc license",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to"
           " this work",
    "cc-by-nc-4-short": "licensed under cc by nc 4 0",
    "cc-by-4-short": "licensed under cc by 4 0",
    "cc-by-sa-4-short": "licensed under cc by sa 4 0",
    "cc-by-nc-sa-4-short": "licensed under cc by nc sa 4 0",
    "cc-by-4": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-4": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-4": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is"
                 " hereby granted provided that the above copyright notice and this permission notice appear in all"
                 " copies",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial"
                  " applications and to alter it and redistribute it freely subject to the following restrictions",
    "boost-distributed": "distributed under the boost software license version 1 0",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the"
                   " software and accompanying documentation covered by this license the software to use reproduce"
                   " display distribute execute and transmit the software and to prepare derivative works of the"
                   " software and to permit third parties to whom the software is furnished to do so all subject to"
                   " the following",
    "epl2-available": "this program and the accompanying materials are made available under the terms of the eclipse"
                      " public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu"
                   " lesser general public license as published by the free software foundation either version 2 1 of"
                   " the license or at your option any later version",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu"
                  " lesser general public license as published by the free software foundation either version 3 of"
                  " the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even"
                 " the implied warranty of merchantability or fitness for a particular purpose",
    "agpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu"
                  " affero general public license as published by the free software foundation either version 3 of the"
                  " license or at your option any later version",
}
#: Ordered rules: licence, identifiers. Fixed values.
RULES = [
    ("MIT", ["mit-released"]), ("MIT", ["mit-licensed"]), ("MIT", ["mit-project"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]), ("MIT", ["mit-title", "mit-grant"]),
    ("MIT", ["mit-title-short", "mit-grant"]),
    ("Apache-2.0", ["apache-licensed"]), ("Apache-2.0", ["apache-licensed-the", "apache-may-not"]),
    ("Apache-2.0", ["apache-may-not", "apache-obtain", "apache-basis"]),
    ("GPL-3.0-only", ["gpl3-work"]), ("GPL-3.0-only", ["gpl3-licensed"]),
    ("GPL-2.0-only", ["gpl2-work"]), ("GPL-2.0-only", ["gpl2-licensed"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]), ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope"]),
    ("LGPL-3.0-only", ["lgpl3-licensed"]), ("AGPL-3.0-only", ["agpl3-licensed"]),
    ("MPL-2.0", ["mpl2-subject"]), ("MPL-2.0", ["mpl2-licensed"]),
    ("BSD-2-Clause", ["bsd2-licensed"]), ("BSD-3-Clause", ["bsd3-licensed"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("ISC", ["isc-licensed"]), ("CC0-1.0", ["cc0"]), ("Unlicense", ["unlicense"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-short"]), ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4-short"]), ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-short"]), ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4-short"]),
    ("ISC", ["isc-grant"]), ("Zlib", ["zlib-warranty", "zlib-grant"]),
    ("BSL-1.0", ["boost-distributed"]), ("BSL-1.0", ["boost-grant"]), ("EPL-2.0", ["epl2-available"]),
    ("LGPL-2.1-or-later", ["lgpl21-free", "lgpl-hope"]), ("LGPL-3.0-or-later", ["lgpl3-free", "lgpl-hope"]),
    ("AGPL-3.0-or-later", ["agpl3-free", "gpl-hope"]),
]
# An identifier line names any of these licences.
for _name in sorted({licence for licence, _ in RULES}):
    SENTENCES[f"spdx-{_name}"] = "spdx license identifier " + _name.lower().replace("-", " ").replace(".", " ")
    RULES.append((_name, [f"spdx-{_name}"]))
GAP = 3
#: What a known sentence can begin with, at the ends of its words.
PREFIXES = {" ".join(w[:n]) for w in map(str.split, SENTENCES.values()) for n in range(1, len(w) + 1)}
#: Words before and after the name of a holder, and what stands for the name in the known sentences.
HOLDERS = [("neither the name of", "nor the names of its contributors may be used", "the copyright holder"),
           ("to the extent possible under law", "has waived all copyright", "the author")]
#: So many words of a holder's name at most.
NAME_WORDS = 20
#: A known sentence, wrapped and with a holder's name, may have so many pieces, as a piece has a word at least.
LONGEST = max(len(s.split()) for s in SENTENCES.values()) + NAME_WORDS
OUTPUT = ("sentences", "licences", "matches")


def sentences_of(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"([.!?])[ \t\r\x0B\f]+", "$1\n"), "\n")


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"^[^\p{L}\p{N}]*(?:[0-9]{1,2}|[a-z])\)|[^\p{L}\p{N}]+", " "))


def _found(pieces: Column, known: Column, prefixes: set[str], most: int) -> Column:
    """Known sentences (``position`` of the first piece, ``last`` piece, ``id``) in normalised
    pieces; ``most`` pieces have the longest."""
    def named(text: Column) -> Column:
        for before, after, name in HOLDERS:
            text = F.regexp_replace(text, f"^{before} .+? {after}", f"{before} {name} {after}")
        return text

    def upto(start: Column, n: Column) -> Column:
        return F.concat_ws(" ", F.slice(pieces, start + 1, n))  # a blank piece leaves two blanks, which match nothing

    def from_here(start: Column) -> Column:
        two = upto(start, F.lit(2))
        wrapped = two.isin(*prefixes)
        for before, _, _ in HOLDERS:
            wrapped = wrapped | two.startswith(before + " ")
        ends = F.sequence(F.lit(1), F.when(wrapped, F.least(F.lit(most), F.size(pieces) - start)).otherwise(F.lit(1)))
        hits = F.transform(ends, lambda n: F.struct(
            start.cast("int").alias("position"), (start + n - 1).cast("int").alias("last"),
            F.try_element_at(known, named(upto(start, n))).alias("id")))
        return F.filter(hits, lambda h: h["id"].isNotNull())

    def begins(piece: Column) -> Column:
        some = piece.isin(*prefixes)
        for before, _, _ in HOLDERS:
            some = some | piece.startswith(before + " ")
        return some

    starts = F.filter(F.transform(pieces, lambda s, i: F.when(begins(s), i)), lambda i: i.isNotNull())
    return F.flatten(F.transform(starts, from_here))


def scan(df: DataFrame, text_col: str = "text", sentences: dict[str, str] | None = None,
         rules: list[tuple[str, list[str]]] | None = None, gap: int = GAP) -> DataFrame:
    """Every row with the known sentences in its text, the licences recognised, and the matches.

    ``sentences``: array of (``position`` of its first piece, from 0, ``id``) in text order; the pieces
    between line ends and sentence ends are what positions and gaps count. ``matches``: array of
    (``licence``, ``rule``, ``first``, ``last`` sentence), one for each occurrence of a rule;
    ``licences``: their distinct names, sorted. An occurrence begins at a sentence with the rule's
    first identifier and goes on with the nearest that fits; occurrences of one rule do not share
    their first sentence. A null or empty text has none, an empty table gives an empty result, and
    input columns with the name of an output column are replaced.
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    known = F.create_map(*[F.lit(x) for i, s in sentences.items() for x in (s, i)])
    name = free_name(df, "__hits")
    words = [s.split() for s in sentences.values()]
    prefixes = PREFIXES if sentences is SENTENCES else {" ".join(w[:n]) for w in words for n in range(1, len(w) + 1)}
    most = LONGEST if sentences is SENTENCES else max(map(len, words)) + NAME_WORDS
    pieces = F.transform(sentences_of(text_or_empty(text_col)), normalised)
    # bound to a name by a lambda, so that pieces are cut once
    found = F.transform(F.array(pieces), lambda p: _found(p, known, prefixes, most))[0]
    hits = df.select(*map(quoted, without(df, OUTPUT)), found.alias(name))
    own = F.col(name)

    def nearest(after: Column, wanted: str) -> Column:
        """Where the wanted sentence comes next, if it does within the gap."""
        near = F.filter(own, lambda h: (h["id"] == wanted) & (h["position"] > after)
                        & (h["position"] <= after + gap + 1))
        return F.array_min(F.transform(near, lambda h: F.struct(h["position"], h["last"])))["last"]

    def occurrences(number: int, licence: str, ids: list[str]) -> Column:
        """Of one rule, from each sentence that has its first identifier."""
        def extended(start: Column) -> Column:
            last = start["last"]
            for wanted in ids[1:]:
                last = nearest(last, wanted)
            return F.struct(F.lit(licence).alias("licence"), F.lit(number).alias("rule"),
                            start["position"].alias("first"), last.alias("last"))
        return F.filter(F.transform(F.filter(own, lambda h: h["id"] == ids[0]), extended),
                        lambda m: m["last"].isNotNull())

    none = F.from_json(F.lit("[]"), "array<struct<licence string, rule int, first int, last int>>")
    matches = F.when(F.size(own) == 0, none).otherwise(
        F.concat(*[occurrences(i, licence, ids) for i, (licence, ids) in enumerate(rules)]))
    kept = [quoted(c) for c in without(df, OUTPUT)]
    return (hits.withColumn("matches", matches)
            .select(*kept, F.transform(own, lambda h: F.struct(
                h["position"], h["id"])).alias("sentences"), F.array_sort(F.array_distinct(F.transform(
                "matches", lambda m: m["licence"]))).alias("licences"), "matches"))
