"""License scan: base places by definition, notices, awkward rows."""
import re

from martlight.llm import licenses as lic, queries
from tests.llm.common import SF, awkward, documents, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    """(n_words, n_base, first, last, labels) by the contract's words."""
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    at = [(i, label) for phrase, label in lic.BASE_PHRASES for p in [phrase.split()]
          for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    places = [i for i, _ in at]
    return (len(w), len(at), min(places, default=None), max(places, default=None),
            ",".join(sorted({x for _, x in at})))


def check(out, docs):
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))     # noqa: E731
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out]
    assert sorted(got, key=key) == sorted(((d, *base(t)) for d, t in docs), key=key)
    for r in out:
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not r["n_base"]) and (r["score"] > 0) == (r["labels"] != "")


def test_query_equals_definition(spark):
    check(queries.op10_licenses(spark, SF).collect(), documents())


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in lic.scan(df).collect()}


def test_notices_with_words_inserted_or_dropped(spark):
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted"
    r = scan(spark, [bsd, bsd.replace("binary ", "binary code "), bsd.replace("source and ", ""),
                     "Licensed under CC BY-NC 4.0.", "binary forms of the source", "forms in use and source",
                     "the MIT-License; MIT License. mit  license", "mit, license general public license"])
    assert [r[i]["labels"] for i in range(8)] == ["bsd", "bsd", "bsd", "cc-by-nc", "", "", "mit", "gpl,mit"]
    assert r[0]["score"] == 1.0 and 0.8 <= r[2]["score"] <= 1.0
    assert (r[6]["n_base"], r[6]["first_word"], r[6]["last_word"]) == (3, 1, 5)


def test_awkward_rows(spark):
    df = awkward(spark)
    check(lic.scan(df).collect(), [(r["doc_id"], r["text"]) for r in df.collect()])


def test_empty_table(spark):
    assert lic.scan(empty(spark)).collect() == []


def test_every_template_finds_itself(spark):
    phrases = [(p, label) for p, label in lic.BASE_PHRASES + lic.notices()]
    r = scan(spark, [p for p, _ in phrases])
    for i, (p, label) in enumerate(phrases):
        assert label in r[i]["labels"].split(","), p


def test_long_texts_cost_their_length(spark):
    """Half a million words with a hit every fifty: places and counts are exact."""
    text = " ".join("mit license" if i % 50 == 0 else f"w{i % 999}" for i in range(500_000))
    row = lic.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_words"], row["n_base"], row["first_word"], row["base_labels"]) == (510_000, 10_000, 0, "mit")
    assert row["last_word"] == 499_950 + 9_999


MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.
The above copyright notice and this permission notice shall be included in all copies or portions of the Software."""
BSD_BODY = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice.
2. Redistributions in binary form must reproduce the above copyright notice in the documentation.
Neither the name of the author nor the names of its contributors may be used to endorse or promote products."""


def test_bodies_with_a_few_words_changed(spark):
    changed = [MIT_BODY, MIT_BODY.replace("hereby ", "").replace("obtaining", "getting").replace("shall", "must"),
               BSD_BODY, BSD_BODY.replace("source code", "the source code").replace("must reproduce", "shall reproduce"),
               "Copies of the notice are in the box; you may sell the rights in any form.",
               "// SPDX-License-Identifier: Apache-2.0", "# SPDX-License-Identifier: GPL-3.0-or-later",
               "This library is free software; you can share it.", "This program is free software: you can share it.",
               "This is free and unencumbered software released into the public domain."]
    r = scan(spark, [f"Some words before. {t} Some words after." for t in changed])
    assert [r[i]["labels"] for i in range(len(changed))] == [
        "mit", "mit", "bsd", "bsd", "", "apache,spdx", "gpl,spdx", "lgpl", "gpl", "unlicense"]
