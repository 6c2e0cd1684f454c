"""Licence scan by sentence recognition, with DataFrame functions only.

Method
------
A text is normalised (lower case, runs of other characters than letters,
digits and inner dots to one space, so also comment marks) into lines: every
line break, ``;`` and ``:`` ends a line, every sentence end and blank line a
paragraph.  Known licence sentences, each of which has an identifier, are found
where they begin and end with a line; inside they may be wrapped over lines of
one paragraph.  The longest sentence at a place is taken.  The
document's sequence of identifiers is matched against ordered rules: a rule
names a licence and a sequence of identifiers; a place that a rule matches is
used up before later rules are tried.  Identifiers that refer to a licence on
their own (``ref:...``) name it where no rule used them.  ``SPDX`` lines hold
expressions: each licence in one is named, whatever joins them (exceptions are
no licences).

Scale: everything happens within a row -- no shuffle, no join, no explode --
so a document costs what its text costs, and a hot source nothing more.
Texts are normalised only if they hold a key word; every known sentence
holds one (a test makes sure).

Defined results
---------------
* null or empty text: no sentences, ``licenses`` empty;
* null ids and repeated rows: every row is scanned on its own;
* a licence found twice is named once, in order of the rules, then of the
  references by place, then of the expressions;
* a very long text is scanned whole;
* an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

#: Ends of sentences; the dot of a version ("v. 2.0") is none.
SENTENCE_END = r"(?:[!?]|\.(?!(?<=\bv\.)\s+[0-9]))\s+"
#: Every known sentence holds one of these.
KEY = r"(?i)licen|copyright|warrant|permission|redistribut|public|liab|endorse|gnu|spdx"

# Names under which licences are referred to, as normalised text.
NAMES = {
    "MIT": ("mit license", "mit licence"),
    "Apache-2.0": ("apache license version 2.0", "apache license 2.0", "apache 2.0 license"),
    "GPL-2.0": ("gnu general public license version 2", "gpl version 2", "gnu gpl v2"),
    "GPL-3.0": ("gnu general public license version 3", "gpl version 3", "gnu gpl v3"),
    "LGPL-2.0": ("gnu library general public license version 2",),
    "LGPL-2.1": ("gnu lesser general public license version 2.1", "gnu lgpl v2.1"),
    "LGPL-3.0": ("gnu lesser general public license version 3",),
    "AGPL-3.0": ("gnu affero general public license version 3",),
    "MPL-2.0": ("mozilla public license version 2.0", "mozilla public license v. 2.0"),
    "BSD-2-Clause": ("bsd 2 clause license", "simplified bsd license"),
    "BSD-3-Clause": ("bsd 3 clause license", "new bsd license", "bsd license"),
    "ISC": ("isc license",),
    "EPL-2.0": ("eclipse public license version 2.0", "eclipse public license 2.0"),
    "CC-BY-4.0": ("cc by 4.0", "creative commons attribution 4.0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4.0", "creative commons attribution sharealike 4.0 international license"),
    "CC-BY-NC-4.0": ("cc by nc 4.0", "creative commons attribution noncommercial 4.0 international license"),
    "CC-BY-ND-4.0": ("cc by nd 4.0",),
    "CC0-1.0": ("cc0 1.0", "cc0 1.0 universal"),
    "Unlicense": ("unlicense",),
    "BSL-1.0": ("boost software license version 1.0",),
    "Zlib": ("zlib license",),
    "Artistic-2.0": ("artistic license 2.0",),
    "EUPL-1.2": ("european union public licence version 1.2", "eupl version 1.2"),
}
# Licences by the names that expressions give them.
SPDX = (
    "0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-1-Clause "
    "BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 "
    "CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GPL-2.0 GPL-2.0-only "
    "GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.0 LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 "
    "LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL "
    "NCSA OFL-1.1 OSL-3.0 PostgreSQL PSF-2.0 Unicode-3.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib "
    "ZPL-2.1").split()
#: A line's expression, and the names in it.
SPDX_LINE = r"(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)"
SPDX_NAME = r"[A-Za-z0-9.+-]+"
# GNU licences: short name, words, versions.
GNU = (("gpl", "GPL", "gnu general public license", ("2", "3")),
       ("lgpl", "LGPL", "gnu lesser general public license", ("2.1", "3")),
       ("lgpl", "LGPL", "gnu library general public license", ("2",)),
       ("agpl", "AGPL", "gnu affero general public license", ("3",)))
# How their notices begin, and what they say of versions.
GNU_WORKS = ("program", "library", "software", "file")
GNU_HEAD = "this {work} is free software you can redistribute it and or modify it under the terms of the {name}"
GNU_LATER = (" as published by the free software foundation either version {v} of the license or at your option "
             "any later version",)
GNU_ONLY = (" as published by the free software foundation version {v} of the license",
            " as published by the free software foundation version {v} only",
            " version {v} as published by the free software foundation", " version {v} only")
GNU_WARRANTY = ("this {work} is distributed in the hope that it will be useful but without any warranty without "
                "even the implied warranty of merchantability or fitness for a particular purpose")
# What a sentence says of a name.
PHRASES = ("licensed under {}", "licensed under the {}", "released under {}", "released under the {}",
           "this work is licensed under {}", "this work is licensed under the {}",
           "this project is licensed under the {}", "this software is licensed under the {}",
           "this file is licensed under the {}", "distributed under the {}",
           "distributed under the terms of the {}", "available under the {}",
           "the {}", "{}")
# Sentences of licence texts and notices, normalised.
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this "
                 "software and associated documentation files the software to deal in the software "
                 "without restriction including without limitation the rights to use copy modify merge "
                 "publish distribute sublicense and or sell copies of the software and to permit persons "
                 "to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies "
                  "or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied "
                    "including but not limited to the warranties of merchantability fitness for a "
                    "particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or "
                 "without fee is hereby granted provided that the above copyright notice and this "
                 "permission notice appear in all copies",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard "
                    "to this software including all implied warranties of merchantability and fitness",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are "
                 "permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of "
                  "conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of "
                  "conditions and the following disclaimer in the documentation and or other materials "
                  "provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be "
                   "used to endorse or promote products derived from this software without specific "
                   "prior written permission",
    "apache-header": "licensed under the apache license version 2.0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-warranty": "unless required by applicable law or agreed to in writing software distributed "
                       "under the license is distributed on an as is basis without warranties or "
                       "conditions of any kind either express or implied",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial "
                  "applications and to alter it and redistribute it freely subject to the following restrictions",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of "
                   "the software and accompanying documentation covered by this license",
    "mpl-header": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "unlicense-grant": "this is free and unencumbered software released into the public domain",
    "rights-reserved": "copyright all rights reserved",
}
# Rules in the order in which they are tried.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-grant",)),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("ISC", ("isc-grant",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-1-Clause", ("bsd-grant", "bsd-source")),
    ("Apache-2.0", ("apache-header", "apache-comply", "apache-copy", "apache-warranty")),
    ("Apache-2.0", ("apache-header", "apache-comply")),
    ("Apache-2.0", ("apache-header",)),
    ("MPL-2.0", ("mpl-header",)),
    ("Unlicense", ("unlicense-grant",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("boost-grant",)),
)


def gnu_notices() -> tuple[dict[str, str], tuple]:
    """Sentences and rules of the GNU licences' notices, by family, version and
    whether later versions are allowed."""
    sentences, rules = {}, []
    for short, spdx, name, versions in GNU:
        for v, (way, tails) in product(versions, (("later", GNU_LATER), ("only", GNU_ONLY))):
            key = f"{short}{v.replace('.', '_')}-{way}"
            licence = f"{spdx}-{v if '.' in v else v + '.0'}-{'or-later' if way == 'later' else 'only'}"
            for work, tail in product(GNU_WORKS, tails):
                sentences[(GNU_HEAD + tail).format(work=work, name=name, v=v)] = key
            rules += [(licence, (key, "gpl-warranty")), (licence, (key,))]
    sentences.update({GNU_WARRANTY.format(work=w): "gpl-warranty" for w in GNU_WORKS})
    return sentences, tuple(dict.fromkeys(rules))


_GNU_SENTENCES, _GNU_RULES = gnu_notices()
RULES += _GNU_RULES


def spdx_names() -> dict[str, str]:
    """Lower-cased name in an expression -> licence; ``+`` allows later
    versions."""
    out = {s.lower(): s for s in SPDX}
    out.update({f"{s.lower()}+": f"{s}-or-later" for s in SPDX if f"{s}-or-later" in SPDX})
    return out


def known_sentences() -> dict[str, str]:
    """Normalised sentence -> identifier: the fixed sentences, and every
    phrase with every name."""
    out = {}
    for licence, names in NAMES.items():
        for phrase, name in product(PHRASES, names):
            text = phrase.format(name)
            if re.search(KEY, text):
                out[text] = f"ref:{licence}"
            out[f"spdx license identifier {licence.lower().replace('-', ' ')}"] = f"ref:{licence}"
    out.update({text: name for name, text in SENTENCES.items()})
    out.update(_GNU_SENTENCES)
    # as the normaliser leaves them: no dot at the end of a word
    return {re.sub(r"\.(?=\s|$)", "", text): name for text, name in out.items()}


def normalised(text: Column) -> Column:
    """Lower case; letters, digits and dots between them; single spaces; a line
    break at each end of a line, two or more at each end of a paragraph."""
    out = F.lower(text)
    for pattern, by in ((r"\r\n?", "\n"),
                        (r"(?md)^[^a-z0-9\n]+", ""),               # comment marks
                        (SENTENCE_END, "\n\n"),
                        (r"[;:][^\S\n]+(?=\S)", "\n"),
                        (r"[^a-z0-9.\n]+", " "),
                        (r"\.(?=\s|\z)|(?<!\S)\.", " "),
                        (r" +", " "), (r" ?\n ?", "\n")):
        out = F.regexp_replace(out, pattern, by)
    return F.trim(out)


def sentence_pattern(known) -> str:
    """Known sentences from the start of a line to the end of one, longest
    first, as a tree of their words."""
    tree: dict = {}
    for text in known:
        node = tree
        for word in text.split(" "):
            node = node.setdefault(word, {})
        node[""] = {}

    def written(node: dict) -> str:
        ways = [re.escape(w) + after(n) for w, n in node.items() if w]
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"

    def after(node: dict) -> str:
        if not any(node):
            return ""
        rest = r"[ \n]" + written(node)
        return f"(?:{rest})?" if "" in node else rest
    return rf"(?md)^{written(tree)}$" if tree else r"(?!)"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  sentences: dict[str, str] | None = None, rules=RULES) -> DataFrame:
    """(id_col, sentences, licenses): the identifiers in the order of the text,
    and the licences, an array each."""
    known = known_sentences() if sentences is None else sentences
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    text = normalised(F.when(F.col(text_col).rlike(KEY), F.col(text_col)).otherwise(""))
    found = F.transform(F.regexp_extract_all(text, F.lit(sentence_pattern(known)), F.lit(0)),
                        lambda s: F.try_element_at(table, F.translate(s, "\n", " ")))
    ids = F.filter(found, lambda x: x.isNotNull())
    none = F.array().cast("array<string>")
    out = docs.select(F.col(id_col), ids.alias("sentences"),
                      F.coalesce(spdx_licenses(F.col(text_col)), none).alias("spdx"))
    # rules in order, on the sequence written as ",a,,b,"; a match is used up
    out = out.withColumn("left", F.concat_ws("", F.transform("sentences", lambda x: F.concat(F.lit(","), x, F.lit(",")))))
    hits = []
    for n, (licence, sequence) in enumerate(rules):
        text = "".join(f",{x}," for x in sequence)
        # the licence, where the text without this rule's matches is shorter
        out = out.withColumn(f"hit{n}", F.when(F.contains("left", F.lit(text)), licence)) \
            .withColumn("left", F.replace("left", F.lit(text), F.lit("")))
        hits.append(f"hit{n}")
    refs = F.transform(F.filter(F.split("left", ","), lambda x: x.startswith("ref:")),
                       lambda x: F.substring(x, 5, 100))
    licences = F.array_distinct(F.concat(F.array_compact(F.array(*hits)) if hits else F.array(), refs, "spdx"))
    return out.select(id_col, "sentences", licences.alias("licenses"))


def spdx_licenses(text: Column) -> Column:
    """The licences that a text's SPDX lines name, in order."""
    table = F.create_map(*[F.lit(x) for pair in spdx_names().items() for x in pair])
    names = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(SPDX_LINE), F.lit(1)),
                                  lambda e: F.regexp_extract_all(e, F.lit(f"({SPDX_NAME})"), F.lit(1))))
    found = F.filter(F.transform(names, lambda n: F.try_element_at(table, F.lower(n))), lambda x: x.isNotNull())
    return F.when(text.rlike("(?i)spdx"), found).otherwise(F.array().cast("array<string>"))
