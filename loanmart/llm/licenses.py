"""Licence scans by sentence rules.

Texts are normalised to lower-case words; known licence sentences are found wherever their
words stand (an anchor of three words finds candidates, all words are compared then), and each
becomes its sentence identifier, with a version where the sentence has one. A document's
identifiers, in order, are matched against ordered rules: at each place the first rule whose
identifiers follow one another there gives a licence and takes them; an identifier that no
rule takes is reported as such.

Defined results: NULL and empty texts have no sentences and no licences; of sentences that
overlap, the one that starts first counts, then the longer one; repeated licences of one
document are named once, in order of first appearance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import ALNUM, LOWER, hash_text, run_hashes, schema_with, span_hashes, text_blocks, word_spans

#: Sentences of public licences, normalised; <v> is a version of one or two numbers.
SENTENCES = {
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit_liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mit_released": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc_warranty": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "bsd_grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd_warranty": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "apache_licensed": "licensed under the apache license version <v>",
    "apache_use": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at",
    "gpl_terms": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version <v> of the license",
    "lgpl_terms": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version <v> of the license",
    "agpl_terms": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version <v> of the license",
    "or_later": "or at your option any later version",
    "gpl_licensed": "licensed under the gnu general public license version <v>",
    "lgpl_licensed": "licensed under the gnu lesser general public license version <v>",
    "agpl_licensed": "licensed under the gnu affero general public license version <v>",
    "mpl_terms": "this source code form is subject to the terms of the mozilla public license v <v>",
    "cc_by": "licensed under cc by <v>",
    "cc_by_sa": "licensed under cc by sa <v>",
    "cc_by_nd": "licensed under cc by nd <v>",
    "cc_by_nc": "licensed under cc by nc <v>",
    "cc_by_nc_sa": "licensed under cc by nc sa <v>",
    "cc_by_nc_nd": "licensed under cc by nc nd <v>",
    "cc_by_long": "licensed under a creative commons attribution <v> international license",
    "cc_by_sa_long": "licensed under a creative commons attribution sharealike <v> international license",
    "cc_by_nc_long": "licensed under a creative commons attribution noncommercial <v> international license",
    "public_domain": "released into the public domain",
    "all_rights": "all rights reserved",
}

#: Ordered rules, first the more specific ones; {} is the sentence's version.
RULES = [
    ("MIT", ["mit_grant", "mit_notice", "mit_warranty", "mit_liability"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_warranty"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("MIT", ["mit_released"]),
    ("MIT", ["mit_licensed"]),
    ("ISC", ["isc_grant", "isc_warranty"]),
    ("ISC", ["isc_grant"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_name", "bsd_warranty"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_name"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_warranty"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("Apache-{}", ["apache_licensed", "apache_use", "apache_copy"]),
    ("Apache-{}", ["apache_licensed", "apache_use"]),
    ("Apache-{}", ["apache_licensed"]),
    ("GPL-{}-or-later", ["gpl_terms", "or_later"]),
    ("LGPL-{}-or-later", ["lgpl_terms", "or_later"]),
    ("AGPL-{}-or-later", ["agpl_terms", "or_later"]),
    ("GPL-{}-or-later", ["gpl_licensed", "or_later"]),
    ("LGPL-{}-or-later", ["lgpl_licensed", "or_later"]),
    ("AGPL-{}-or-later", ["agpl_licensed", "or_later"]),
    ("GPL-{}", ["gpl_terms"]),
    ("LGPL-{}", ["lgpl_terms"]),
    ("AGPL-{}", ["agpl_terms"]),
    ("GPL-{}", ["gpl_licensed"]),
    ("LGPL-{}", ["lgpl_licensed"]),
    ("AGPL-{}", ["agpl_licensed"]),
    ("MPL-{}", ["mpl_terms"]),
    ("CC-BY-NC-SA-{}", ["cc_by_nc_sa"]),
    ("CC-BY-NC-ND-{}", ["cc_by_nc_nd"]),
    ("CC-BY-NC-{}", ["cc_by_nc"]),
    ("CC-BY-NC-{}", ["cc_by_nc_long"]),
    ("CC-BY-SA-{}", ["cc_by_sa"]),
    ("CC-BY-SA-{}", ["cc_by_sa_long"]),
    ("CC-BY-ND-{}", ["cc_by_nd"]),
    ("CC-BY-{}", ["cc_by"]),
    ("CC-BY-{}", ["cc_by_long"]),
    ("public-domain", ["public_domain"]),
    ("proprietary", ["all_rights"]),
]

ANCHOR = 3


class SentenceTable:
    """Sentences by the hash of their first three words."""

    def __init__(self, sentences: dict[str, str]):
        self.names, self.words = list(sentences), []
        anchors = []
        for text in sentences.values():
            words = text.split()
            assert "<v>" not in words[:ANCHOR] and len(words) >= ANCHOR
            hashes = [None if w == "<v>" else hash_text(w) for w in words]
            self.words.append(hashes)
            anchors.append(int(run_hashes(np.array(hashes[:ANCHOR], np.uint64), ANCHOR)[0]))
        order = np.argsort(np.array(anchors, np.uint64), kind="stable")
        self.anchors = np.array(anchors, np.uint64)[order]
        self.order = order.tolist()

    def match(self, number: int, hashes: np.ndarray, at: int, stop: int, is_number) -> tuple[int, int, int] | None:
        """(end, version start, version end) of a sentence that stands at a word, or None."""
        version = (-1, -1)
        for want in self.words[number]:
            if want is None:
                k = at
                while k < min(stop, at + 2) and is_number(k):
                    k += 1
                if k == at:
                    return None
                version, at = (at, k), k
            elif at < stop and int(hashes[at]) == want:
                at += 1
            else:
                return None
        return at, *version

    def sentences(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[str, str]]]:
        """(identifier, version) of the sentences of every row, in order."""
        low = LOWER[data]
        starts, ends, row = word_spans(low, offsets, ALNUM)
        out: list[list[tuple[str, str]]] = [[] for _ in range(len(offsets) - 1)]
        hashes = span_hashes(low, starts, ends)
        runs = run_hashes(hashes, ANCHOR)
        if not len(runs):
            return out
        left = np.searchsorted(self.anchors, runs, "left")
        right = np.searchsorted(self.anchors, runs, "right")
        last = np.searchsorted(row, row, "right")
        word = lambda k: low[starts[k] : ends[k]].tobytes()
        free = 0
        for at in np.flatnonzero((right > left) & (row[:-2] == row[2:])).tolist():
            if at < free:
                continue
            best = None
            for k in range(left[at], right[at]):
                number = self.order[k]
                found = self.match(number, hashes, at, last[at], lambda k: word(k).isdigit())
                if found and (best is None or found[0] > best[0][0]):
                    best = found, number
            if best:
                (free, a, b), number = best
                out[row[at]].append((self.names[number], ".".join(word(k).decode() for k in range(a, b)) if a >= 0 else ""))
        return out


def apply_rules(found: list[tuple[str, str]], rules=RULES) -> tuple[list[str], list[str]]:
    """Licences of a sequence of identifiers, and the identifiers that no rule takes."""
    ids = [i for i, _ in found]
    licences, rest, at = [], [], 0
    while at < len(ids):
        for name, wanted in rules:
            if ids[at : at + len(wanted)] == wanted:
                version = next((v for _, v in found[at : at + len(wanted)] if v), "")
                licences.append(name.format(version if "." in version or not version else version + ".0"))
                at += len(wanted)
                break
        else:
            rest.append(ids[at])
            at += 1
    return list(dict.fromkeys(licences)), rest


def scan_licences(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", sentences: dict[str, str] | None = None, rules: list | None = None) -> DataFrame:
    """``keep`` columns, licences, sentence_ids and unmatched_ids (comma-joined), n_sentences of every row."""
    table, rules = SentenceTable(sentences or SENTENCES), rules or RULES
    picked = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column("_text")):
                found = table.sentences(data, offsets)
                ruled = [apply_rules(f, rules) for f in found]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in keep), pa.array([",".join(x) for x, _ in ruled], pa.string()), pa.array([",".join(i for i, _ in f) for f in found], pa.string()),
                                                  pa.array([",".join(x) for _, x in ruled], pa.string()), pa.array(list(map(len, found)), pa.int64())], [*keep, "licences", "sentence_ids", "unmatched_ids", "n_sentences"])

    return picked.mapInArrow(run, schema_with(picked.drop("_text"), "licences string, sentence_ids string, unmatched_ids string, n_sentences long"))
