import math
import re
import textwrap

import pytest

from quire.llm.licences import BRIEF, GATE, HALF, NAME, SHARED, SURE, examples, op10_licences, scan, train
from quire.llm.notices import MARKS, NAMES, OTHER, SHORT, TEMPLATES, WORDINGS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))


def words(passage):
    text = re.sub("((?:gp|mp)l)v(?=[0-9])", r"\1 v", re.sub("licen[cs]e", "license", passage.lower()))
    return re.findall(r"cc0|[^\W\d_]+|\d+", text)


def grams(passage):
    own = words(passage)
    return {*own, *(" ".join(p) for p in zip(own, own[1:], strict=False))}


def paragraphs(text):
    """Lines of a text, wrapped ones joined, by a plain loop."""
    out, joined = [], ""
    lines = text.split("\n")
    for k, line in enumerate(lines):
        joined = f"{joined.rstrip()} {line}" if joined else line
        bare = line.rstrip(" \t\r")
        goes_on = bare and bare[-1] not in ".!?:;。" and not bare[-1].isspace() and k + 1 < len(lines) and re.match(r"[ \t#*/;%!>-]*[^\W_\n]|[ \t#*/;%!>-]*[\"'(\[]", lines[k + 1])
        if not goes_on:
            out.append(joined)
            joined = ""
    return out


def plain(model, passage):
    """Family, probability and similarity of a passage, from weights and notices alone; None: unknown."""
    own = grams(passage)
    if not own & set(model.grams):
        return None
    z = [b + sum(model.grams[g][k] for g in own & set(model.grams)) for k, b in enumerate(model.intercept)]
    p = 1 / (1 + math.exp(-(model.slope * (max(z[1:]) - z[0]) + model.offset)))
    best = (0.0, 0.0, "")
    for family, forms in [*TEMPLATES.items(), *SHORT.items()]:
        for form in map(grams, forms):
            share, pairs = len(form & own) / len(form), [g for g in form if " " in g]
            both, all_ = (sum(" " in g for g in x) for x in (form & own, own))
            part = min(len(form & own) / max(1, len(own)), both / all_ if all_ else 1.0) if {*MARKS} & form else 0.0
            share = 0.0 if {*MARKS} & form - own else max(part, share / 2 if len(form) < BRIEF and share < 1 else share)
            best = max(best, (share, max(part, len({*pairs} & own) / len(pairs) if pairs else 1.0), family))
    for family, names in NAMES.items():
        for form in map(grams, names):
            if form <= own:
                share = NAME + len(form) / 1_000
                best = max(best, (share, max(share, 1.0), family))
    share, pairs, family = best
    return (family, p, share) if p >= GATE and pairs >= HALF and (share >= SHARED or p >= SURE and share >= HALF) else None


def scanned(spark, model, texts):
    return {r.doc_id: r for r in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}


def test_whole_notices_are_kept_for_the_calibration(spark):
    rows = examples(spark.read.parquet(f"{SF}/documents.parquet"), 300).collect()
    kept, learnt = ({r.passage for r in rows if r.kept == k and r.family in TEMPLATES} for k in (True, False))
    for ts in TEMPLATES.values():
        for k, t in enumerate(ts):
            assert (t in kept) == (k % 4 == 3) and (t in learnt) == (k % 4 != 3)
    corpus = [r for r in rows if r.family == "unknown" and "\n" not in r.passage and r.passage[:1].isupper() and not any(r.passage in t or t.startswith(r.passage[:20]) for t in OTHER)]
    assert 0 < len(corpus) <= 300 + 5 * len(OTHER)
    assert not any(t in r.passage for r in corpus for ts in TEMPLATES.values() for t in ts)


def test_notices_kept_from_learning_and_comparison_are_found(spark, model):
    held = [(f, t) for f, ts in TEMPLATES.items() for k, t in enumerate(ts) if k % 4 == 3]
    held += [(f, t) for f, ts in SHORT.items() for k, t in enumerate(ts) if k // (len(ts) // len(WORDINGS)) % 4 == 3]
    texts = spark.createDataFrame(list(enumerate(t for _, t in held)), "doc_id long, text string")
    got = {r.doc_id: r.family for r in scan(texts, model, all_=False).collect()}
    right = sum(got.get(k) == f for k, (f, _) in enumerate(held))
    assert right >= 0.9 * len(held), [(h, got.get(k)) for k, h in enumerate(held) if got.get(k) != h[0]]
    all_ = [(f, t) for f, ts in TEMPLATES.items() for t in ts]
    got = scanned(spark, model, [t for _, t in all_])
    missed = [t for k, (f, t) in enumerate(all_) if k not in got or got[k].family != f]
    assert len(missed) <= 1 and not [r for k, r in got.items() if r.family != all_[k][0]], missed


def test_short_notices_in_words_never_seen(spark, model):
    texts = {
        "This package is MIT licensed.": "MIT", "License: Apache-2.0": "Apache-2.0", "Licensed under GPLv3 or later.": "GPL", "Licensed under the GNU GPL v3.": "GPL", "SPDX-License-Identifier: MIT": "MIT", "// SPDX-License-Identifier: (LGPL-2.1-or-later OR MIT)": "LGPL",
        "Our library is made available under the Mozilla Public License 2.0.": "MPL", "The text of this page is licensed under CC BY-SA 4.0.": "CC-BY-SA", "Images: CC BY-NC 4.0 license.": "CC-BY-NC", "The tool is distributed under the AGPLv3 licence.": "AGPL",
        "Code in this folder is under the BSD 3-Clause License.": "BSD", "The data is released under CC0.": "CC0", "Licenced under the LGPL v2.1.": "LGPL", "This repository is licensed under the Apache License 2.0.": "Apache-2.0", "All scripts are MIT licensed, see LICENSE.": "MIT", "Available under the GNU Affero General Public License v3.": "AGPL",
    }
    got = scanned(spark, model, texts)
    wrong = {t: got[k].family if k in got else None for k, (t, f) in enumerate(texts.items()) if k not in got or got[k].family != f}
    assert len(wrong) <= 2, wrong  # MIT as one word of a short sentence, which German has too
    assert got[3].family == "GPL" and got[3].confirmed


def test_notices_in_other_words_and_wrapped(spark, model):
    mit = TEMPLATES["MIT"][1]
    texts = {
        textwrap.fill(mit, 80): "MIT",
        "# " + textwrap.fill(mit, 70).replace("\n", "\n# "): "MIT",
        "Copyright (c) 2019 Jane Roe\n\n" + textwrap.fill(mit, 76): "MIT",
        "This file is part of Foo and is licensed under the MIT License.": "MIT",
        "Foo is licensed under the Apache License, Version 2.0, as you wish.": "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS.": "Apache-2.0",
        "Neither the name of Foo Inc nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.": "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted.": "BSD",
    }
    got = scanned(spark, model, texts)
    assert {k: r.family for k, r in got.items()} == dict(enumerate(texts.values()))
    assert got[0].confirmed and got[1].confirmed and got[1].paragraph == 0


def test_other_uses_of_such_words_are_unknown(spark, model):
    texts = [
        "The new edition was released by the university under the bridge.",
        "Their version of the work, released in 2021, was granted a public prize under the new law.",
        "The committee met on Monday.\nA driving license is needed.\nGeneral remarks on the public version.\nDer Zug mit dem Ziel kommt mit und ohne Halt.",
        "The library closed its doors; the license was granted to the owner of the bar in public.",
        "He said all rights to the film were reserved by the studio.",
        "The Apache helicopter, version 2.0, was shown to the public.",
        "This package is licensed under the Artistic Bakery Terms.",
        "The committee released the report to the public under law.",
        " ".join(sorted(TEMPLATES["MIT"][1].lower().split()))[:60],
        *OTHER,
    ]
    assert scanned(spark, model, texts) == {}
    assert 20 < len(model.grams) < 2_000


def test_odd_rows(spark, model):
    mit = "Released under the MIT License."
    rows = [(1, f"x.\n{mit}", "a"), (1, f"x.\n{mit}", "a"), (1, f"y.\n\n{mit} ", "b"), (None, mit, None), (2, None, "c"), (3, "", "c"), (4, "word " * 200_000 + mit, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, family string")
    got = sorted((str(r.doc_id), r.paragraph, r.family, r.confirmed) for r in scan(docs, model).collect())
    assert got == [("1", 1, "MIT", True), ("1", 2, "MIT", True), ("4", 0, "MIT", True), ("None", 0, "MIT", True)]
    assert scan(docs.limit(0), model).count() == 0
    empty = train(docs.limit(0))
    assert scan(docs, empty).count() > 0


def test_query_against_weights(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = train(docs)
    got = {(r.doc_id, r.paragraph): (r.family, r.probability, r.similarity) for r in op10_licences(spark, SF).collect()}
    want = {}
    for r in docs.collect():
        for k, passage in enumerate(paragraphs(r.text)):
            if found := plain(model, passage):
                want[r.doc_id, k] = found
    assert want and set(got) == set(want)
    for k, (family, p, share) in want.items():
        assert got[k] == (family, pytest.approx(p, abs=1e-5), pytest.approx(share, abs=1e-5))
