"""Cases of the second review: shingles of the pipeline's stage, notices of other licences, account numbers before words, long listed paths."""

from llm_cases import documents, near_components, words

import corpus_pipeline
from foliograph.llm import licenses, pii, url_filter


def test_stage_takes_five_words(spark):
    """With n / 40 scattered edits two texts are near copies by four words, and not by five."""
    base = words(800, 11)
    edited = [f"new{i}" if i % 40 == 20 else w for i, w in enumerate(base)]
    few = [f"new{i}" if i % 80 == 20 else w for i, w in enumerate(words(800, 12))]
    rows = list(enumerate([" ".join(x) for x in (base, edited, words(800, 12), few)]))
    four, five = ({c for _, c in near_components(rows, shingle=n).values()} for n in (4, 5))
    assert four == {0, 2} and five == {0, 1, 2}
    out = corpus_pipeline.drop_near_copies(spark, documents(spark, [t for _, t in rows]), "")
    assert {r.doc_id for r in out.collect()} == five


NOT_THESE = {
    "Released under the BSD license.": "mit", "It was released under the hood of a car.": "mit", "Kept under the MIT hood": "mit",
    "Licensed under the Mozilla Public License, Version 2.0": "apache", "Licensed under the Eclipse Public License, Version 2.0": "apache",
    'Licensed under the Educational Community License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at": "apache",
    "This work is licensed under the Open Software License, version 3": "gpl",
    "This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0": "mpl",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by",
    "Licensed under CC BY-SA 4.0.": "cc-by-nc", "Licensed under CC BY 4.0.": "cc-by-nc", "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc",
    "Part of this publication may be reproduced": "proprietary", "this is free software released into the public domain": "unlicense",
}
THESE = {
    "This work is licensed under a Creative Commons Attribution 3.0 Unported License": "cc-by", "Licensed under CC BY-NC 3.0": "cc-by-nc",
    "Released under the MIT licence.": "mit", "All rights reserved. No part of this book may be reproduced": "proprietary",
    "Distributed under the BSD license. Licensed under the Apache License, Version 2.0.": "apache",
}


def test_other_licences_get_no_label(spark):
    texts = [*NOT_THESE, *THESE, *(t for _, t in licenses.TEMPLATES)]
    got = {r.doc_id: r for r in licenses.summary(licenses.scan(documents(spark, texts))).collect()}
    for i, t in enumerate(texts):
        if t in NOT_THESE:
            assert got[i].labels == "" and got[i].score == 0, t
        else:
            assert (THESE | {t: label for label, t in licenses.TEMPLATES})[t] in got[i].labels.split(","), t


def test_short_templates_without_marks():
    scanner = licenses.Scanner(templates=(("own", "given away under the house rules"),), base=())
    assert scanner.scan(licenses.words_of("given away under the table rules"))[1] == []
    assert [s[0] for s in scanner.scan(licenses.words_of("it is given away under the house rules"))[1]] == ["own"]


def test_grouped_ibans_before_words(spark):
    ibans = ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "LU28 0019 4006 4475 0000",
             "SE45 5000 0000 0583 9825 7466", "PL61 1090 1014 0000 0712 1981 2874", "NO93 8601 1117 947", "GB82 WEST 1234 5698 7654 32",
             "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]
    behind = ["BIC", "USD", "2024", "7", "A", "IBAN BIC"]
    texts = [*ibans, *(f"pay {i} {b} now" for i in ibans for b in behind), "BE68 5390 0754 7034 4524 1322 6465 2876"]
    got = [r.text for r in pii.pseudonymise(documents(spark, texts), "test").orderBy("doc_id").collect()]
    new = got[: len(ibans)]
    assert all(a != b and a[:2] == b[:2] and len(a) == len(b) for a, b in zip(ibans, new, strict=True))
    assert got[len(ibans) : -1] == [f"pay {i} {b} now" for i in new for b in behind]
    # the card behind the account number is one too
    assert got[-1].startswith(new[1] + " ") and "4524 1322 6465 2876" not in got[-1]


def test_long_listed_paths(spark):
    long_ = "/" + "é" * (url_filter.LONGEST_PATH - 1)
    rules = [("net", long_, "block"), ("net", long_ + "a", "allow"), ("x.net", long_ + "ab", "block"), ("net", long_ + "c" * 900, "block"), ("net", "/", "allow")]
    cases = [("net", long_[:-1], 4), ("net", long_, 0), ("net", long_ + "a", 1), ("net", long_ + "ab", 1), ("x.net", long_ + "abc", 2),
             ("net", long_ + "c" * 899, 0), ("y.net", long_ + "c" * 901, 3), ("org", long_ + "ab", None)]
    pages = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p, _) in enumerate(cases)], "page_id long, url string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    for bits in ({}, {"max_bytes": 1}):
        got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, listed, default="none", **bits).collect()}
        assert got == {i: ("".join(rules[n][:2]), rules[n][2]) if n is not None else (None, "none") for i, (_, _, n) in enumerate(cases)}
