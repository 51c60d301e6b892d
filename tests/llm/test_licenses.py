import re

from loanmart.llm import queries
from loanmart.llm.licenses import RULES, SENTENCES, apply_rules, scan_licences
from tests.conftest import SF_MID


def brute(text):
    """Sentences of a text by one regular expression for each, on its normalised words."""
    words = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
    spans = []
    for name, s in SENTENCES.items():
        pattern = r"(?<!\S)" + re.escape(s).replace(r"\ ", " ").replace("<v>", r"([0-9]+(?: [0-9]+)?)") + r"(?!\S)"
        spans += [(m.start(), -m.end(), name, (m[1].replace(" ", ".") if m.groups() else "")) for m in re.finditer(pattern, words)]
    out, free = [], -1
    for start, end, name, version in sorted(spans):
        if start > free:
            out.append((name, version))
            free = -end
    return out


def test_query_against_brute_force(spark):
    texts = dict(spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect())
    got = queries.QUERIES["op8_licences"](spark, SF_MID).collect()
    assert len(got) == len(texts)
    for r in got:
        found = brute(texts[r.doc_id])
        assert r.sentence_ids == ",".join(i for i, _ in found) and r.licences == ",".join(apply_rules(found)[0])
    assert {"MIT", "Apache-2.0"} <= {r.licences for r in got}


def test_sequences_and_edges(spark):
    mit = ". ".join(SENTENCES[k].capitalize() for k in ("mit_grant", "mit_notice", "mit_warranty", "mit_liability"))
    bsd = "\n * ".join(SENTENCES[k] for k in ("bsd_grant", "bsd_source", "bsd_binary"))
    rows = [(1, mit), (2, bsd), (3, bsd + "; " + SENTENCES["bsd_name"]), (4, None), (5, ""), (6, SENTENCES["bsd_name"]), (7, "x " * 50_000 + "Licensed under the Apache License, Version 2.0."),
            (8, "This work is licensed under the GNU General Public License, version 3 or (at your option) any later version."), (8, "Released under the MIT License. released under the MIT license"), (None, "Licensed under CC BY-NC 4.0.")]
    got = sorted(((r.doc_id or 0), r.licences, r.unmatched_ids, r.n_sentences) for r in scan_licences(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, licences int")).collect())
    assert got == sorted([(1, "MIT", "", 4), (2, "BSD-2-Clause", "", 3), (3, "BSD-3-Clause", "", 4), (4, "", "", 0), (5, "", "", 0), (6, "", "bsd_name", 1), (7, "Apache-2.0", "", 1),
                          (8, "GPL-3.0-or-later", "", 2), (8, "MIT", "", 2), (0, "CC-BY-NC-4.0", "", 1)])
    assert all(set(ids) <= set(SENTENCES) for _, ids in RULES)
    assert scan_licences(spark.createDataFrame([], "doc_id long, text string")).collect() == []
