"""Licences in texts, recognised by their sentences.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import column

# Sentences of public licence texts and notices, normalised, by identifier.
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including without "
    "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
    "and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other "
    "liability whether in an action of contract tort or otherwise arising from out of or in connection with the "
    "software or the use or other dealings in the software",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-project": "this project is licensed under the mit license",
    "mit-spdx": "spdx license identifier mit",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-at": "you may obtain a copy of the license at",
    "apache-url": "http www apache org licenses license 2 0",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license "
    "is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "apache-licensed": "licensed under the apache license version 2 0",
    "apache-project": "this project is licensed under the apache license version 2 0",
    "apache-spdx": "spdx license identifier apache 2 0",
    "gpl-free-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation either version 3 of the license or at your "
    "option any later version",
    "gpl-free-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation either version 2 of the license or at your "
    "option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even "
    "the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-program": "this program is free software",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation",
    "gnu-either-2": "either version 2 of the license or at your option any later version",
    "gnu-either-2.1": "either version 2 1 of the license or at your option any later version",
    "gnu-either-3": "either version 3 of the license or at your option any later version",
    "gpl-useful": "this program is distributed in the hope that it will be useful but without any warranty",
    "gnu-even": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-library": "this library is free software",
    "lgpl-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license "
    "as published by the free software foundation",
    "lgpl-free-3": "this library is free software you can redistribute it and or modify it under the terms of the gnu "
    "lesser general public license as published by the free software foundation either version 3 of the license or at "
    "your option any later version",
    "agpl-free-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "affero general public license as published by the free software foundation either version 3 of the license or at "
    "your option any later version",
    "gpl-details": "see the gnu general public license for more details",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "gpl-work-3": "this work is licensed under the gnu general public license version 3",
    "gpl-licensed-3": "licensed under the gnu general public license version 3",
    "gpl-licensed-2": "licensed under the gnu general public license version 2",
    "gpl-spdx-3": "spdx license identifier gpl 3 0 or later",
    "bsd-use": "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and "
    "the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc0": "to the extent possible under law the author s have dedicated all copyright and related and neighboring "
    "rights to this software to the public domain worldwide",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-liable": "in no event will the authors be held liable for any damages arising from the use of this software",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
    "software and accompanying documentation covered by this license the software to use reproduce display distribute "
    "execute and transmit the software and to prepare derivative works of the software and to permit third parties to "
    "whom the software is furnished to do so all subject to the following",
    "mpl-terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-long": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by-sa-long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-nc-long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
}

# A licence and a run of identifiers that stands for it, the more complete
# runs of a licence first.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-project",)),
    ("MIT", ("mit-spdx",)),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-header", "apache-comply", "apache-copy", "apache-basis", "apache-see")),
    ("Apache-2.0", ("apache-header", "apache-comply", "apache-at", "apache-url", "apache-basis", "apache-see")),
    ("Apache-2.0", ("apache-header", "apache-comply")),
    ("Apache-2.0", ("apache-licensed",)),
    ("Apache-2.0", ("apache-project",)),
    ("Apache-2.0", ("apache-spdx",)),
    ("GPL-3.0", ("gpl-free-3", "gpl-hope", "gpl-details", "gpl-received")),
    ("GPL-3.0", ("gpl-free-3", "gpl-hope")),
    ("GPL-3.0", ("gpl-free-3", "gpl-useful", "gnu-even")),
    ("GPL-3.0", ("gpl-program", "gpl-terms", "gnu-either-3")),
    ("GPL-3.0", ("gpl-work-3",)),
    ("GPL-3.0", ("gpl-licensed-3",)),
    ("GPL-3.0", ("gpl-spdx-3",)),
    ("GPL-2.0", ("gpl-free-2", "gpl-hope", "gpl-details", "gpl-received")),
    ("GPL-2.0", ("gpl-free-2", "gpl-hope")),
    ("GPL-2.0", ("gpl-free-2", "gpl-useful", "gnu-even")),
    ("GPL-2.0", ("gpl-program", "gpl-terms", "gnu-either-2")),
    ("GPL-2.0", ("gpl-licensed-2",)),
    ("LGPL-2.1", ("lgpl-library", "lgpl-terms", "gnu-either-2.1")),
    ("LGPL-3.0", ("lgpl-library", "lgpl-terms", "gnu-either-3")),
    ("LGPL-3.0", ("lgpl-free-3",)),
    ("AGPL-3.0", ("agpl-free-3",)),
    ("BSD-3-Clause", ("bsd-use", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-use", "bsd-source", "bsd-binary")),
    ("MPL-2.0", ("mpl-terms",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0",)),
    ("Zlib", ("zlib-as-is", "zlib-liable")),
    ("BSL-1.0", ("boost-grant",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-4.0", ("cc-by-long",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-long",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-long",)),
)

# Licences whose rules are longer runs of the same sentences: the first includes the second.
INCLUDES = (("BSD-3-Clause", "BSD-2-Clause"),)

# Every known sentence has one of these, so that others need not be normalised.
TRIGGER = r"(?i)licen[sc]e|permission|warrant|conditions|liab|free software|redistribut|copyright|public domain"
# What a line starts with before its sentence: comment leaders, then the number of a list.
LEADERS = r"(^|\n)[ \t]*(?:#+|//+!?|/\*+!?|\*+/?|--+|;+|%+|<!--)?[ \t]*(?:(?:[0-9]{1,2}[.)]|\([0-9a-z]{1,2}\))[ \t]+)?"
# A sentence ends at a mark before white space, at a colon that ends a line, and at the end
# of a line (as in notices) or only of a paragraph (as in wrapped texts); both readings are
# tried.
ENDS = (r"[.!?;]+(?:[ \t\r\n]|$)|\n", r"[.!?;]+(?:[ \t\r\n]|$)|:[ \t\r]*\n|\n[ \t\r]*\n")
_NOT_WORD = r"[^a-z0-9\x{80}-\x{10FFFF}]+"

assert all(re.search(TRIGGER, s) for s in SENTENCES.values())


def normalised(sentence: Column) -> Column:
    """A-Z lowered, anything but ASCII letters, digits and other alphabets one space."""
    lowered = F.translate(sentence, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lowered, _NOT_WORD, " "))


def identifiers(text: Column, ends: str) -> Column:
    """ARRAY<STRING>: the identifiers of the known sentences of a text, in order.

    Lines count without the comment leader or list number that they start with."""
    known = F.create_map(*[F.lit(v) for name, sentence in SENTENCES.items() for v in (sentence, name)])
    bare = F.regexp_replace(text, LEADERS, "$1")
    likely = F.filter(F.split(bare, ends), lambda s: F.regexp_like(s, F.lit(TRIGGER)))
    return F.array_compact(F.transform(likely, lambda s: F.try_element_at(known, normalised(s))))


def matched(sequence: Column) -> Column:
    """ARRAY<STRING>: the licences whose rules a sequence of identifiers holds, by name.

    The sentences of a rule follow each other, with none but unknown ones between.
    """
    joined = F.concat(F.lit(">"), F.array_join(sequence, ">"), F.lit(">"))
    found = {}
    for licence, rule in RULES:
        hit = F.contains(joined, F.lit(">" + ">".join(rule) + ">"))
        found[licence] = found[licence] | hit if licence in found else hit
    for larger, smaller in INCLUDES:
        found[smaller] = found[smaller] & ~found[larger]
    return F.array_compact(F.array(*[F.when(found[name], F.lit(name)) for name in sorted(found)]))


def license_scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, sentences, licences), one for each document.

    ``sentences`` are the identifiers of the known sentences, with lines as sentences or,
    where that recognises fewer, with wrapped lines joined; ``licences`` what either
    reading matches, by name. Texts without any (NULL and empty ones too) have empty
    arrays. All of it is worked out within the row: one scan, nothing shuffled.
    """
    value = F.coalesce(column(df, text).cast("string"), F.lit(""))
    none = F.array().cast("array<string>")
    likely = F.regexp_like(value, F.lit(TRIGGER))
    read = df.select(
        column(df, key).alias("key"),
        *[F.when(likely, identifiers(value, ends)).otherwise(none).alias(f"ids_{i}") for i, ends in enumerate(ENDS)],
    )
    longer = F.when(F.size("ids_1") > F.size("ids_0"), F.col("ids_1")).otherwise(F.col("ids_0"))
    licences = F.array_sort(F.array_union(matched(F.col("ids_0")), matched(F.col("ids_1"))))
    return read.select(F.col("key").alias(key), longer.alias("sentences"), licences.alias("licences"))
