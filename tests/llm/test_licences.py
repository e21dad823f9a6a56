import pytest

from vitrina.llm import licences
from vitrina.llm.queries import table

from .conftest import EDGE, make_docs
from tests.conftest import MEDIUM

ROWS = [
    (1, "Some prose here.\nReleased under the MIT License.\nMore prose."), (2, "Licensed under the Apache License, Version 2.0."),
    (3, "x\nThis work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0."),
    (4, "Licensed under CC BY 4.0."), (5, "This code is licensed under the Mozilla Public License, version 2.0"),
    (6, "She has a license to drive.\nThe warranty of this car ended."), (7, "The copyright of the song belongs to nobody."),
    (8, "our files: released under the MIT license"), (9, "SPDX-License-Identifier: Apache-2.0"), (10, None), (11, ""),
    (12, "A licence nobody has heard of: the Example Corporation End User License Agreement governs all copies."),
    (1, "Some prose here.\nReleased under the MIT License.\nMore prose."),
]
WANT = {1: "1:MIT", 2: "0:Apache-2.0", 3: "1:GPL-3.0,2:CC-BY-NC-4.0", 4: "0:CC-BY-4.0", 5: "0:MPL-2.0", 6: "", 7: "", 8: "0:MIT", 9: "0:Apache-2.0", 10: "", 11: "", 12: ""}


@pytest.fixture(scope="module")
def model(spark):
    from vitrina.llm.shared import id_text

    return licences.fit(id_text(table(spark, MEDIUM, "documents")))


def test_families(spark, model):
    got = licences.scan(make_docs(spark, ROWS), model).collect()
    assert sorted((r.doc_id, r.paragraphs) for r in got) == sorted((i, WANT[i]) for i, _ in ROWS)
    assert all(r.n_paragraphs == len([x for x in r.paragraphs.split(",") if x]) for r in got)
    assert {r.families for r in got if r.doc_id == 3} == {"CC-BY-NC-4.0,GPL-3.0"}


def test_lines_of_the_given_documents(spark, model):
    docs = table(spark, MEDIUM, "documents")
    got = {r.doc_id: r for r in licences.scan(docs, model).collect()}
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Released under the MIT License.": "MIT"}
    for r in docs.collect():
        want = [f"{k}:{lines[p]}" for k, p in enumerate((r.text or "").split("\n")) if p in lines]
        assert got[r.doc_id].paragraphs == ",".join(want)


def test_edge_rows(spark, edge_docs, no_docs, model):
    assert licences.scan(edge_docs, model).where("n_paragraphs > 0").count() == 0
    assert licences.scan(edge_docs, model).count() == len(EDGE)
    assert licences.scan(no_docs).count() == 0


def test_no_python_in_the_plan(spark, edge_docs, model):
    plan = licences.scan(edge_docs, model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version."""


def test_short_names_and_wrapped_notices(spark, model):
    rows = [(1, "Released under CC0 1.0 Universal."), (2, "x\nCC0 1.0 Universal"), (3, f"Some prose.\n \n{GPL.format(3)}\n\nMore prose."),
            (4, GPL.format(2)), (5, f"Released under the MIT License.\n{GPL.format(3)}"), (6, "Er kam mit dem Zug.\nMIT IHM KAM NIEMAND."),
            (7, "She has a license to drive.\nThe warranty of this car ended.\nNobody had the permission."),
            (8, "Released under the GNU LGPL, version 3."), (9, "Released under the MPL, version 2.0.")]
    got = {r.doc_id: r.paragraphs for r in licences.scan(make_docs(spark, rows), model).collect()}
    # the third line of the wrapped header is clear by itself only in version 2
    assert got == {1: "0:CC0-1.0", 2: "1:CC0-1.0", 3: "2:GPL-3.0", 4: "2:GPL-2.0", 5: "0:MIT,1:GPL-3.0", 6: "", 7: "", 8: "0:LGPL-3.0", 9: "0:MPL-2.0"}


UNKNOWN_NOTICES = [
    "Licensed under the Example Corp License, Version 2.0.", "This work is licensed under the GNU Affero General Public License, version 3.",
    "Licensed under the Blue Whale License, Version 2.0.", "Released under the Sleepy Cat License.", "Licensed under the Initech license.",
    "This work is licensed under the Acme General Terms, version 3.", "This Source Code Form is subject to the terms of the Globex Public License, v. 2.0.",
    "Licensed under the Eclipse Public License, version 2.0.", "SPDX-License-Identifier: AGPL-3.0-only", "SPDX-License-Identifier: EPL-2.0",
    "Use of this software is governed by the Business Source License 1.1.", "Released under the Business Source License, version 1.1.",
]


def test_notices_of_other_licences_are_unknown(spark, model):
    rows = list(enumerate(UNKNOWN_NOTICES))
    got = {r.doc_id: r.paragraphs for r in licences.scan(make_docs(spark, rows), model).collect()}
    assert got == dict.fromkeys(got, "")


def test_precision_and_recall_on_notices_with_words_around_them(spark, model):
    """Every template with words that no training copy has before and behind it."""
    known = [(k, t) for k, own in licences.TEMPLATES.items() for t in own]
    rows = [(n, f"Notice for readers: {t} Thank you kindly") for n, (_, t) in enumerate(known)]
    got = {r.doc_id: r.families for r in licences.scan(make_docs(spark, rows), model).collect()}
    right = sum(got[n] == k for n, (k, _) in enumerate(known))
    wrong = sum(got[n] not in ("", k) for n, (k, _) in enumerate(known))
    assert wrong == 0 and right >= 0.9 * len(known), [(t, got[n]) for n, (k, t) in enumerate(known) if got[n] != k]
