from __future__ import annotations

import random
from collections import Counter

import pytest
import zstandard

from spanvec.llm import license_scan as L

TABLE = "/root/testdata/sf0.01/documents.parquet"


def test_every_notice_is_found_and_nothing_else(spark):
    """Against a search for the literal notices, over a whole table."""
    docs = spark.read.parquet(TABLE)
    got = {r.doc_id: r.licenses for r in L.scan_documents(docs).collect()}
    want = {}
    for r in docs.select("doc_id", "text").collect():
        names = {name for name, text in L.TEMPLATES if text.lower() in (r.text or "").lower()}
        want[r.doc_id] = ",".join(sorted(names)) or None
    assert got == want and Counter(want.values()).total() > len({None})


@pytest.mark.parametrize(("name", "text"), L.TEMPLATES)
def test_templates_win_on_their_own_wording(name, text):
    scanner = L.Scanner(L.TEMPLATES, 0.0, 0.1)
    block = f"Some words before. {text.upper()} And after."
    plain = len(zstandard.ZstdCompressor(level=L.LEVEL, write_content_size=False).compress(block.lower().encode()))
    given = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packed = zstandard.ZstdCompressor(level=L.LEVEL, write_content_size=False, write_dict_id=False, dict_data=given).compress(block.lower().encode())
    at = next(i for i, (n, t) in enumerate(L.TEMPLATES) if (n, t) == (name, text))
    assert scanner.savings(block)[at] == (plain - len(packed)) / plain
    assert name in {m.license for m in scanner.matches(block)}


def test_wording_decides():
    scanner = L.Scanner(L.TEMPLATES, 0.0, 0.1)
    assert not scanner.scan("Licensed under the Apache License, Version 3.0.")
    assert not scanner.scan("Not released, and under no MIT-like License.")
    assert [m.license for *_, m in scanner.scan("This work is licensed under the GNU General Public License, version 2.")] == ["GPL-2.0"]
    loose = L.Scanner(L.TEMPLATES, 0.2, 0.1)
    (hit,) = [m for *_, m in loose.scan("Licensed under the new Apache License, Version 2.0.") if m.license == "Apache-2.0"]
    assert hit.missing == () and hit.added == ("new",)
    text = "A line.\nLicensed under the Apache License,\nVersion 2.0.\nLicensed under CC BY-NC 4.0."
    assert [text[b:e] for b, e in L.candidates(text)] == ["Licensed under the Apache License,", "Licensed under CC BY-NC 4.0."]
    long = "Words go on. " * 40 + "Released under the MIT License. " + "Words go on. " * 40
    ((begin, end, hit),) = scanner.scan(long)
    assert long[begin:end] == "Released under the MIT License." and hit.license == "MIT"


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    for docs in (odd_docs, clashing_docs):
        rows = L.scan_documents(docs).collect()
        assert len(rows) == 11 and all((r.n_candidates, r.n_licenses, r.license) == (0, 0, None) for r in rows)
        assert L.scan_blocks(docs).count() == 0
    assert L.scan_documents(no_docs).count() == 0


def test_a_longer_block_hides_no_notice():
    scanner = L.Scanner(L.TEMPLATES, 0.0, 0.1)
    rng = random.Random(5)
    unrelated = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(35))
    for name, text in L.TEMPLATES:
        ((_, _, hit),) = [h for h in scanner.scan(f"Copyright {unrelated} {text}") if h[2].license == name]
        assert hit.missing == hit.added == ()
    notices = "\n".join(text for _, text in L.TEMPLATES)
    assert {m.license for *_, m in scanner.scan(notices)} == {name for name, _ in L.TEMPLATES}


def test_notices_over_lines_and_tags():
    scanner = L.Scanner(L.TEMPLATES, 0.0, 0.1)

    def found(text):
        return sorted(m.license for *_, m in scanner.scan(text))

    assert found("Licensed under the Apache License,\nVersion 2.0.") == ["Apache-2.0"]
    assert found("This Source Code Form is subject to the terms of\nthe Mozilla Public License, v. 2.0.") == ["MPL-2.0"]
    assert found("Licensed under the\nCC BY 4.0.") == ["CC-BY-4.0"]
    assert found("# SPDX-License-Identifier: (MIT OR Apache-2.0)\ncode") == ["Apache-2.0", "MIT"]
    assert found("Write SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 AND MIT. in each file.") == ["GPL-2.0-only", "MIT"]
    for name, text in L.TEMPLATES:
        wrapped = "\n# ".join(text.split(" "))
        assert name in found(f"# {wrapped}\n")
    assert not found("The\nMozilla Public License, v. 3.0.")
