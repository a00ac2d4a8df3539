from __future__ import annotations

import pytest

from demandlab.llm import licenses

PLAIN = ["Rain fell all day on the quiet town.", "the und der la of que with words", "He may use this to open any of the doors.",
         "numbers 1.0 and 2.0 are here"]


@pytest.fixture(scope="module")
def scanner(some_documents):
    return licenses.train(some_documents)


def test_families(make_docs, scanner):
    texts = ["Intro line\nLicensed under the Apache License, Version 2.0.\nend", "Released under the MIT License.",
             "x\nThis work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0.",
             "RELEASED UNDER THE MIT LICENSE.\nReleased under the MIT License.", None, "", "\n\n", "\n".join(PLAIN), "word " * 30_000,
             "Redistribution and use in source and binary forms, with or without modification, are permitted"]
    rows = {r.doc_id: r for r in licenses.scan(make_docs(texts, clash=True), scanner).collect()}
    assert [rows[i].families for i in range(10)] == [
        ["apache"], ["mit"], ["cc", "gpl"], ["mit"], [], [], [], [], [], ["bsd"]]
    assert [rows[i].n_lines for i in (0, 2, 3, 4, 5, 6, 7)] == [3, 3, 2, 0, 0, 0, 4]
    assert rows[3].n_licensed == 2 and rows[7].n_unknown == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""


def test_wrapped_notices_and_other_families(make_docs, scanner):
    texts = {MIT: ["mit"], "\n".join("# " + line for line in MIT.split("\n")): ["mit"],
             "Plain first line.\n" + MIT + "\nPlain last line.": ["mit"],
             "Released under the ISC License.": ["isc"], "Licensed under the Eclipse Public License v2.0.": ["epl"],
             "This program is licensed under the GNU Affero General Public License, version 3.": ["agpl"],
             "This is free and unencumbered software released into the public domain.": ["unlicense"],
             "Released under the GNU General Public License, version 2.": ["gpl"]}
    rows = licenses.scan(make_docs(list(texts)), scanner).orderBy("doc_id").collect()
    assert [r.families for r in rows] == list(texts.values())


def test_licences_that_were_not_learned_are_unknown(make_docs, scanner):
    texts = ["Licensed under the Boost Software License, Version 1.0.", "Released under the Zope Public License, version 2.1."]
    for r in licenses.scan(make_docs(texts), scanner).collect():
        assert (r.n_licensed, r.n_unknown, r.families) == (0, 1, [])


def test_repeated_and_null_ids(make_docs, scanner):
    text = "Released under the MIT License."
    rows = licenses.scan(make_docs([(1, text), (1, text), (None, text), (1, "plain")]), scanner).collect()
    assert sorted((r.doc_id or 0, r.n_licensed) for r in rows) == [(0, 1), (1, 0), (1, 1), (1, 1)]


def test_documents_with_their_notices(some_documents, scanner):
    notices = {"Licensed under CC BY-NC": "cc", "licensed under the GNU General Public": "gpl",
               "Licensed under the Apache License": "apache", "Released under the MIT": "mit"}
    found = {r.doc_id: r.families for r in licenses.scan(some_documents, scanner).collect()}
    for r in some_documents.collect():
        assert found[r.doc_id] == sorted({f for part, f in notices.items() if part in r.text})


def test_empty_tables(make_docs, scanner):
    assert licenses.scan(make_docs([]), scanner).count() == 0
    alone = licenses.train(make_docs([]))
    assert licenses.scan(make_docs(["Released under the MIT License."]), alone).first().families == ["mit"]


def test_a_common_short_notice_is_not_learned_as_none(make_docs, some_documents):
    """Every tenth text of the sample holds it; before, this struck its words from the vocabulary."""
    notices = {"MIT License": "mit", "Apache License": "apache", "License: MIT": "mit"}
    for notice, family in notices.items():
        texts = [r.text for r in some_documents.orderBy("doc_id").collect()]
        table = make_docs([f"{t}\n{notice}" if i % 10 == 0 else t for i, t in enumerate(texts)])
        rows = licenses.scan(make_docs([notice, "plain words"]), licenses.train(table)).orderBy("doc_id").collect()
        assert rows[0].n_licensed == 1 and rows[0].families == [family], notice
        assert rows[1].n_licensed + rows[1].n_unknown == 0
