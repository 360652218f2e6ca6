"""Licence scan by recognised sentences.

Known licence sentences are looked up where they stand in the text, whatever
stands between their words: blanks, line ends, comment marks, punctuation.  So a
notice is found wrapped, unwrapped or with its sentences run together.  Sentences
that are also ordinary speech must begin and end where a sentence or line does.
The identifiers found, in the order of the text, are then matched against ordered
rules, the longest first.  The identifiers of a rule must follow each other with
few unknown sentences and no other known one between them, so clauses scattered
over a text make no licence.  A rule uses up its identifiers, so the version
sentence of one licence does not serve another.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from folioscope.llm.common import per_row

SPAN = ("start", "end", "sentence")
# Identifiers and patterns of well-known licence sentences.  A blank stands for all that
# can be between two words, '~' for the same within a line and sentence, '_' within a paragraph.
SENTENCES = {
    "MIT_NAME": r"(?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?mit license",
    "MIT_GRANT": r"permission is hereby granted free of charge to any person obtaining a copy of this "
    r"software and associated documentation files",
    "MIT_NOTICE": r"the above copyright notice and this permission notice shall be included in all copies "
    r"or substantial portions of the software",
    "AS_IS": r"(?:the|this) software is provided as is",
    "APACHE_2": r"(?:this (?:work|file|software) is )?licensed under the apache license version 2 0"
    r"(?: the license)?",
    "APACHE_COPY": r"you may obtain a copy of the license at",
    "APACHE_COMPLY": r"you may not use this file except in compliance with the license",
    "GPL_3_NAME": r"(?:this (?:work|program|file|software) is )?licensed under the gnu general public license"
    r"(?: version 3| v3)",
    "GPL_2_NAME": r"(?:this (?:work|program|file|software) is )?licensed under the gnu general public license"
    r"(?: version 2| v2)",
    "GPL_FREE": r"this program is free software you can redistribute it and or modify it under the terms of "
    r"the gnu general public license as published by the free software foundation",
    "GPL_3_ONLY": r"(?:redistribute it and or modify it )?under the terms of the gnu general public license version 3"
    r"(?: only)? as published by the free software foundation",
    "GPL_2_ONLY": r"(?:redistribute it and or modify it )?under the terms of the gnu general public license version 2"
    r"(?: only)? as published by the free software foundation",
    "LGPL_FREE": r"is free software you can redistribute it and or modify it under the terms of "
    r"the gnu lesser general public license as published by the free software foundation",
    "AGPL_FREE": r"is free software you can redistribute it and or modify it under the terms of "
    r"the gnu affero general public license as published by the free software foundation",
    "GPL_3_OR_LATER": r"(?:either )?version 3 of the license or at your option any later version",
    "GPL_2_OR_LATER": r"(?:either )?version 2 of the license or at your option any later version",
    "LGPL_21_OR_LATER": r"(?:either )?version 2 1 of the license or at your option any later version",
    "VERSION_3": r"version 3 of the license(?! or at your option)",
    "VERSION_2": r"version 2 of the license(?! or at your option)",
    "VERSION_21": r"version 2 1 of the license(?! or at your option)",
    "ZLIB_GRANT": r"permission is granted to anyone to use this software for any purpose including commercial "
    r"applications and to alter it and redistribute it freely",
    "ZLIB_ORIGIN": r"the origin of this software must not be misrepresented",
    "EPL_1": r"available under the terms of the eclipse public license (?:version |v )?1 0",
    "EPL_2": r"available under the terms of the eclipse public license (?:version |v )?2 0",
    "BSL_1": r"(?:distributed|licensed) under the boost software license version 1 0",
    "CC0": r"dedicated all copyright and related and neighboring rights to this (?:software|work) to the public domain",
    "DUAL": r"(?:dual )?licensed under (?:either of )?(?:the )?(?:terms of )?(?:the )?"
    r"(?P<kind>(?:mit|apache|bsd 3 clause|mozilla public)(?: license)?(?: version)?(?: 2 0)?"
    r" (?:or|and) (?:the )?(?:mit|apache|bsd 3 clause|mozilla public)(?: license)?(?: version)?(?: 2 0)?)",
    "LGPL_NAME": r"licensed under the gnu lesser general public license",
    "AGPL_NAME": r"licensed under the gnu affero general public license",
    "MPL_2": r"this source code form is subject to the terms of the mozilla public license v 2 0",
    "BSD_GRANT": r"redistribution and use in source and binary forms with or without modification are "
    r"permitted provided that the following conditions are met",
    "BSD_BINARY": r"redistributions in binary form must reproduce the above copyright notice",
    "BSD_NAMES": r"neither the name of(?:_(?!neither the name of)[a-z0-9]++)*?_may be used to endorse or "
    r"promote products",
    "ISC_GRANT": r"permission to use copy modify and or distribute this software for any purpose with or "
    r"without fee is hereby granted",
    "UNLICENSE": r"this is free and unencumbered software released into the public domain",
    "PUBLIC_DOMAIN": r"(?:this work is |released )?(?:in|into) the public domain",
    "CC": r"(?:this work is )?licensed under (?:a )?(?:cc|creative commons) "
    r"(?P<kind>by(?: nc)?(?: sa| nd)?|0|zero)(?: (?P<version>[0-9] 0))?",
    "SPDX": r"spdx license identifier[^a-z0-9\n]++(?P<kind>[a-z0-9]++(?:~[a-z0-9]++)*+)",
    "RESERVED": r"all rights reserved",
}
# Sentences that must begin, and that must end, where a sentence or a line does.
BEGINS = {"MIT_NAME", "APACHE_2", "GPL_3_NAME", "GPL_2_NAME", "PUBLIC_DOMAIN", "CC"}
ENDS = BEGINS | {"RESERVED"}
# Licence, and the sentences it shows in this order.
RULES = (
    ("LGPL-3.0-or-later", ("LGPL_FREE", "GPL_3_OR_LATER")),
    ("LGPL-2.1-or-later", ("LGPL_FREE", "LGPL_21_OR_LATER")),
    ("LGPL-2.0-or-later", ("LGPL_FREE", "GPL_2_OR_LATER")),
    ("LGPL-3.0-only", ("LGPL_FREE", "VERSION_3")),
    ("LGPL-2.1-only", ("LGPL_FREE", "VERSION_21")),
    ("AGPL-3.0-or-later", ("AGPL_FREE", "GPL_3_OR_LATER")),
    ("AGPL-3.0-only", ("AGPL_FREE", "VERSION_3")),
    ("GPL-3.0-only", ("GPL_FREE", "VERSION_3")),
    ("GPL-2.0-only", ("GPL_FREE", "VERSION_2")),
    ("GPL-3.0-only", ("GPL_3_ONLY",)),
    ("GPL-2.0-only", ("GPL_2_ONLY",)),
    ("Zlib", ("ZLIB_GRANT", "ZLIB_ORIGIN")),
    ("EPL-1.0", ("EPL_1",)),
    ("EPL-2.0", ("EPL_2",)),
    ("BSL-1.0", ("BSL_1",)),
    ("CC0-1.0", ("CC0",)),
    ("LGPL", ("LGPL_FREE",)),
    ("AGPL", ("AGPL_FREE",)),
    ("GPL-3.0-or-later", ("GPL_FREE", "GPL_3_OR_LATER")),
    ("GPL-2.0-or-later", ("GPL_FREE", "GPL_2_OR_LATER")),
    ("BSD-3-Clause", ("BSD_GRANT", "BSD_BINARY", "BSD_NAMES")),
    ("BSD-2-Clause", ("BSD_GRANT", "BSD_BINARY")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE", "AS_IS")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE")),
    ("Apache-2.0", ("APACHE_2", "APACHE_COMPLY", "APACHE_COPY")),
    ("Apache-2.0", ("APACHE_2",)),
    ("MIT", ("MIT_NAME",)),
    ("GPL-3.0", ("GPL_3_NAME",)),
    ("GPL-2.0", ("GPL_2_NAME",)),
    ("GPL", ("GPL_FREE",)),
    ("LGPL", ("LGPL_NAME",)),
    ("AGPL", ("AGPL_NAME",)),
    ("MPL-2.0", ("MPL_2",)),
    ("ISC", ("ISC_GRANT",)),
    ("Unlicense", ("UNLICENSE",)),
    ("public-domain", ("PUBLIC_DOMAIN",)),
    ("all-rights-reserved", ("RESERVED",)),
)
# Names in a choice of licences.
CHOICES = {"mit": "MIT", "apache": "Apache-2.0", "bsd": "BSD-3-Clause", "mozilla": "MPL-2.0"}
BETWEEN = 4  # unknown sentences between two of a rule
WORDS = 60  # words of a sentence; a longer stretch without an end counts as several
BREAKS = re.compile(r"[.;:!?](?=\s)|\n[^\S\n]*\n")
WORD = re.compile(r"[a-z0-9]+", re.IGNORECASE)
GAP = re.compile(r"[^a-z0-9]*")
GAPS = {
    " ": r"[^a-z0-9]++",
    "~": r"(?:[^a-z0-9\n.;:!?]|[.;:!?](?!\s|$))++",
    "_": r"[^a-z0-9\n]*+(?:\n[^a-z0-9\n]*+)?",
}
STOP = re.compile(r"[.;:!?]")
SPACE = re.compile(r"\s")
ASCII_SMALL = {k: k + 32 for k in range(ord("A"), ord("Z") + 1)}
Known = list[tuple[str, list[str], re.Pattern]]


def compiled() -> Known:
    """Identifier, words the text must have, and pattern of each known sentence."""
    known = []
    for name, sentence in SENTENCES.items():
        plain, many = sentence, 1
        while many:
            plain, many = re.subn(r"\([^()]*\)[*?+]*", "|", plain)
        words = re.findall(r"(?:(?<=[ _~])|^)[a-z]{2,}(?=[ _~]|$)", plain)
        kept = re.split(r"(\(\?P<[a-z]+>)", sentence)
        kept[::2] = (re.sub("[ ~_]", lambda gap: GAPS[gap.group()], part) for part in kept[::2])
        pattern = rf"(?<![a-z0-9])(?:{''.join(kept)})(?![a-z0-9])"
        known.append((name, sorted(set(words), key=len, reverse=True), re.compile(pattern)))
    return known


def _parts(gap: str) -> bool:
    """Whether a line or a sentence ends in what stands between two words."""
    stop = STOP.search(gap)
    return "\n" in gap or bool(stop and SPACE.search(gap, stop.end()))


def _begins(text: str, at: int) -> bool:
    before = at
    while before and not ("a" <= text[before - 1] <= "z" or "0" <= text[before - 1] <= "9"):
        before -= 1
    return not before or _parts(text[before:at])


def _ends(text: str, at: int) -> bool:
    gap = GAP.match(text, at)
    return gap.end() == len(text) or _parts(gap.group())


def identified(name: str, found: re.Match) -> str:
    """The identifier, with the kind and version that some sentences have."""
    kind = found.groupdict().get("kind")
    if kind is None:
        return name
    kind, version = (re.sub("[^a-z0-9]+", " ", x or "") for x in (kind, found.groupdict().get("version")))
    return ":".join((name, "-".join(filter(None, (kind.replace(" ", "-"), version.replace(" ", "."))))))


def sentences(text: str, known: Known) -> list[tuple[int, int, str]]:
    """``(start, end, identifier)`` of each known sentence; no two overlap, the longest wins."""
    small = text.lower()
    if len(small) != len(text):  # places must stay
        small = text.translate(ASCII_SMALL)
    found = []
    for name, words, pattern in known:
        if all(word in small for word in words):
            for m in pattern.finditer(small):
                if (name not in BEGINS or _begins(small, m.start())) and (
                    name not in ENDS or _ends(small, m.end())
                ):
                    found.append((m.start(), m.end(), identified(name, m)))
    kept, until = [], -1
    for start, end, name in sorted(found, key=lambda x: (x[0], -x[1])):
        if start >= until:
            kept.append((start, end, name))
            until = end
    return kept


def unknown(text: str, found: list[tuple[int, int, str]]) -> list[int]:
    """How many unknown sentences stand before each known one, back to the known one before."""
    counts, until = [], 0
    for start, end, _ in found:
        lengths = (sum(1 for _ in WORD.finditer(part)) for part in BREAKS.split(text[until:start]))
        counts.append(sum(-(-n // WORDS) for n in lengths))
        until = end
    return counts


def ruled(names: list[str], before: list[int] | None = None) -> list[str]:
    """Licences whose rules match, in the order of their first sentence; each identifier serves once.

    ``before`` counts the unknown sentences before each identifier.
    """
    free, found = list(names), []
    # A copyright line may stand between the sentences of a notice.
    order = [k for k, name in enumerate(names) if name != "RESERVED"]
    apart = {k: before[k] if before else 0 for k in range(len(names))}
    for place, following in zip(order, order[1:]):
        apart[following] += sum(apart[k] for k in range(place + 1, following))
    for licence, needed in sorted(RULES, key=lambda rule: -len(rule[1])):
        line = list(range(len(names))) if needed == ("RESERVED",) else order
        for at in range(len(line) - len(needed) + 1):
            places = line[at : at + len(needed)]
            near = all(apart[k] <= BETWEEN for k in places[1:])
            if near and all(free[k] == name for k, name in zip(places, needed)):
                for place in places:
                    free[place] = ""
                found.append((places[0], licence))
    for place, name in enumerate(free):
        kind, _, rest = name.partition(":")
        if kind == "CC":
            found.append((place, "CC-" + rest.upper()))
        elif kind == "SPDX":
            found.append((place, rest))
        elif kind == "DUAL":
            choice = [CHOICES[word] for word in rest.split("-") if word in CHOICES]
            found.append((place, (" OR " if "or" in rest.split("-") else " AND ").join(choice)))
    return list(dict.fromkeys(licence for _, licence in sorted(found)))


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, licences, sentences)`` per row of ``docs``.

    ``licences`` lists each licence once; ``sentences`` has start, end and
    identifier of each known sentence, also of those no rule used.  NULL and
    empty texts have none.  Rows that repeat an id get a row each.
    """

    def begin():
        known = compiled()

        def step(texts: list) -> list:
            spans = [sentences(t, known) if t else [] for t in texts]
            licences = [
                ruled([name for _, _, name in s], unknown(t, s)) if s else [] for t, s in zip(texts, spans)
            ]
            return [licences, [[dict(zip(SPAN, span)) for span in s] for s in spans]]

        return step

    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("sentence", pa.string())])
    columns = {
        "licences": ("array<string>", pa.list_(pa.string())),
        "sentences": ("array<struct<start:int, end:int, sentence:string>>", pa.list_(span)),
    }
    return per_row(docs, [key], text, begin, columns)
