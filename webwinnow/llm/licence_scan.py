"""Licence scans by sentence rules.

A text is cut into sentences, each is normalised, and a table of known licence sentences gives some of them an
identifier. A licence rule is an ordered list of identifiers; a text has the licence if it holds them in that order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Sentences of public licences and of common notices, by identifier.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-project": "This project is licensed under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-released": "Released under the Apache License, Version 2.0.",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-notice": "Licensed under the GNU General Public License, version 3.",
    "gpl-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version."
    ),
    "gpl-received": "You should have received a copy of the GNU General Public License along with this program.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met:"
    ),
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
        " disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-name": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "unlicense-anyone": (
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form"
        " or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "gpl2-free": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any"
        " later version."
    ),
    "gpl2-only": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License version 2 as published by the Free Software Foundation."
    ),
    "lgpl21-free": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)"
        " any later version."
    ),
    "lgpl-received": "You should have received a copy of the GNU Lesser General Public License along with this library.",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-only",
    "spdx-bsd3": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-isc": "SPDX-License-Identifier: ISC",
    "spdx-mpl2": "SPDX-License-Identifier: MPL-2.0",
    "spdx-unlicense": "SPDX-License-Identifier: Unlicense",
}

#: Ordered rules: licence, identifiers in the order in which they have to appear.
RULES = (
    ("MIT", ("mit-notice",)), ("MIT", ("mit-licensed",)), ("MIT", ("mit-project",)), ("MIT", ("mit-grant", "mit-condition")), ("MIT", ("spdx-mit",)),
    ("Apache-2.0", ("apache-notice",)), ("Apache-2.0", ("apache-released",)), ("Apache-2.0", ("apache-grant", "apache-comply")), ("Apache-2.0", ("spdx-apache",)),
    ("GPL-3.0", ("gpl3-work",)), ("GPL-3.0", ("gpl3-notice",)), ("GPL-3.0", ("spdx-gpl3",)), ("GPL-3.0-or-later", ("gpl-free", "gpl-received")),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)), ("CC-BY-NC-4.0", ("cc-by-nc-work",)), ("CC-BY-4.0", ("cc-by-notice",)), ("CC-BY-4.0", ("cc-by-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)), ("CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")), ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")), ("BSD-3-Clause", ("spdx-bsd3",)),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-received")), ("GPL-2.0", ("gpl2-only",)), ("LGPL-2.1-or-later", ("lgpl21-free", "lgpl-received")),
    ("ISC", ("isc-grant",)), ("ISC", ("spdx-isc",)), ("Unlicense", ("unlicense-free", "unlicense-anyone")), ("Unlicense", ("spdx-unlicense",)),
    ("MPL-2.0", ("mpl2-subject", "mpl2-copy")), ("MPL-2.0", ("spdx-mpl2",)),
)

#: Every known sentence holds one of these, so texts without them are not cut up at all.
HINT = re.compile(r"licen|permi|redistribut|unencumbered|anyone is free|mozilla", re.IGNORECASE)
_MARKS = re.compile(r"[^a-z0-9]+")
_END = re.compile(r"(?<=[.!?;:])\s+")


@dataclass(frozen=True)
class Hit:
    identifier: str
    start: int


def normal(sentence: str) -> str:
    return _MARKS.sub(" ", sentence.lower()).strip()


_KNOWN = {normal(v): k for k, v in SENTENCES.items()}
_LONGEST = max(len(x.split()) for x in _KNOWN)


def _parts(text: str) -> list[tuple[int, int]]:
    """Pieces between sentence ends and line ends, as spans, in order."""
    cuts = {0, len(text)} | {m.end() for m in _END.finditer(text)} | {m.end() for m in re.finditer(r"\n", text)}
    at = sorted(cuts)
    return list(zip(at[:-1], at[1:]))


def sentence_hits(text: str) -> list[Hit]:
    """Known sentences of *text* in order. A sentence may be broken over lines or hold inner marks, so runs of pieces are
    tried, longest first, up to the words of the longest known sentence; a piece belongs to one sentence. Pieces without
    words are left out first, so a run has no more pieces than words."""
    pieces = [(a, normal(text[a:b])) for a, b in _parts(text)]
    starts, words = [a for a, w in pieces if w], [w for _, w in pieces if w]
    hits, i = [], 0
    while i < len(words):
        run, found, joined = 0, None, ""
        for j in range(i, len(words)):
            joined = f"{joined} {words[j]}".strip()
            run += words[j].count(" ") + 1
            if run > _LONGEST:
                break
            if joined in _KNOWN:
                found = j, _KNOWN[joined]
        if found:
            hits.append(Hit(found[1], starts[i]))
            i = found[0]
        i += 1
    return hits


def matched_rules(identifiers: list[str]) -> list[int]:
    """Numbers of the rules whose identifiers appear in order; a rule that is the start of a longer match is left out."""
    def in_order(wanted: tuple[str, ...]) -> bool:
        left = iter(identifiers)
        return all(x in left for x in wanted)

    found = [k for k, (_, wanted) in enumerate(RULES) if in_order(wanted)]
    return [k for k in found if not any(len(RULES[o][1]) > len(RULES[k][1]) and RULES[o][1][: len(RULES[k][1])] == RULES[k][1] for o in found)]


def _scan(text: str | None) -> tuple[list[str], list[int], list[str]]:
    if not text or not HINT.search(text):
        return [], [], []
    hits = sentence_hits(text)
    names = [h.identifier for h in hits]
    return names, [h.start for h in hits], sorted({RULES[k][0] for k in matched_rules(names)})


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of *docs*: the id, known ``sentences`` and their ``starts`` (code points), and ``licences`` by name.

    Null and empty texts have none. Repeated rows give equal rows; null ids stay null; other columns are ignored; an
    empty table gives an empty result.
    """
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, sentences array<string>, starts array<int>, licences array<string>"

    def run(batches):
        for batch in batches:
            rows = [_scan(t.as_py()) for t in batch.column(1)]
            columns = [pa.array([r[k] for r in rows], pa.list_(kind)) for k, kind in enumerate((pa.string(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, "sentences", "starts", "licences"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def licence_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts of known sentences, the licences, and the first start."""
    found = licences(docs)
    return found.select(
        "doc_id", F.size("sentences").cast("long").alias("n_sentences"), F.array_join("sentences", ",").alias("sentences"),
        F.array_join("licences", ",").alias("licences"), F.coalesce(F.get("starts", F.lit(0)), F.lit(-1)).cast("long").alias("first_start"),
    )
