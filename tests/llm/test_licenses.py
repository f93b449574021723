import os

from cofre.llm import common, licenses

MIT = dict((name, text) for name, text in licenses.KNOWN if len(text) > 500)["MIT"]


def test_whole_texts_and_lines(documents):
    rows = [
        (1, MIT), (2, "Copyright (c) 2020 Somebody\n\n" + MIT.upper().replace(",", " ;")), (3, MIT.replace("sublicense", "sublicence")),
        (4, MIT + "\nand more"), (5, "Text.\nReleased under the MIT Licence!\nMore text.\nreleased under the mit license"), (6, None), (7, ""),
        (None, "Licensed under CC BY-NC 4.0."), (8, "x " * 50_000), (9, "Licensed under CC BY-NC 4.0."), (9, "Licensed under CC BY-NC 4.0."),
        (10, "(c) 1999 Only A Holder"), (11, "...\r\n---\r\n"),
    ]
    found = {(r.key, r.license_id, r.scope): r.n_found for r in licenses.scan_licenses(documents(rows, clashing=True)).collect()}
    assert found == {
        (1, "MIT", "text"): 1, (2, "MIT", "text"): 1, (3, "MIT", "text"): 1, (5, "MIT", "line"): 2,
        (None, "CC-BY-NC-4.0", "text"): 1, (None, "CC-BY-NC-4.0", "line"): 1, (9, "CC-BY-NC-4.0", "text"): 2, (9, "CC-BY-NC-4.0", "line"): 2,
    }


APART = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}


def test_standard_texts_with_title_and_holder(documents):
    """Files as they are found: a title, a holder, other line ends, case and bullets."""
    texts = {name: text for name, text in licenses.KNOWN if len(text) > 500}
    rows, wanted = [], set()
    for i, (name, title) in enumerate([("MIT", "The MIT License (MIT)"), ("ISC", "ISC License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License")]):
        body = texts[name].replace("\n1. ", "\n* ").replace("\n2. ", "\n  * ").replace("\n3. ", "\n- ")
        for j, holder in enumerate(("Copyright Jane Doe 2020", "Copyright (c) 2015-2020, Jane Doe <j@x.org>\nAll rights reserved.", "© Jane Doe", "(c) 2020 Jane Doe")):
            rows.append((100 * i + j, f"{title}\r\n\r\n{holder}\r\n\r\n{body}"))
            wanted.add((100 * i + j, name))
    folder = "/usr/share/common-licenses"
    for i, (file, name) in enumerate(APART.items()):
        if os.path.exists(f"{folder}/{file}"):
            with open(f"{folder}/{file}", encoding="utf-8") as given:
                rows.append((1000 + i, "Copyright 2021 Jane Doe\n" + given.read().replace("\n", "\r\n")))
            wanted.add((1000 + i, name))
    found = licenses.scan_licenses(documents(rows)).where("scope = 'text'").collect()
    assert {(r.key, r.license_id) for r in found} == wanted


def test_a_table_of_other_licences(spark, documents, monkeypatch):
    own = licenses.digests_of(spark.createDataFrame([("own", "You may do as you like."), ("two", "Ask first")], "license_id string, text string"))
    rows = [(1, "you may do as you like"), (2, MIT), (3, "x\nASK FIRST!")]
    for most in (200_000, 0):
        monkeypatch.setattr(common, "BROADCAST_ROWS", most)
        found = licenses.scan_licenses(documents(rows), known=own).collect()
        assert {(r.key, r.license_id, r.scope) for r in found} == {(1, "own", "text"), (1, "own", "line"), (3, "two", "line")}


def test_empty_table(documents):
    assert licenses.scan_licenses(documents([])).count() == 0
