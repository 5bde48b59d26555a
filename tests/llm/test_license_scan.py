import re
import time

from rolefeed.llm import license_scan, queries
from rolefeed.llm.license_texts import TEMPLATES
from tests.llm.helpers import DATA, documents, edge_rows


def test_every_template_is_found_within_other_text():
    index = license_scan.Index()
    for license_, name, text in TEMPLATES:
        whole = "é before it, " + text.strip() + " and after"
        hits = [h for h in index.scan(whole) if TEMPLATES[h[0]][0] == license_]
        assert hits, (license_, name)
        t, matched, coverage, a, b = hits[0]
        if TEMPLATES[t][1] == name:
            assert coverage == 1 and text.strip().startswith(whole[a:b][:20]) and text.strip().rstrip("/.\")").endswith(whole[a:b][-10:])


def test_changed_and_partial_copies():
    index = license_scan.Index()
    words = TEMPLATES[0][2].split()
    changed = " ".join("other" if i % 12 == 5 else w for i, w in enumerate(words))
    (t, matched, coverage, a, b), = index.scan(changed)
    assert TEMPLATES[t][0] == "MIT" and 0.85 < coverage < 1 and a == 0
    assert index.scan(" ".join(words[: len(words) // 2])) == []


def test_copies_in_a_row_are_all_found():
    index = license_scan.Index()
    for license_, name, text in TEMPLATES:
        text = " ".join(text.split())
        if len(text.split()) < 20:
            continue
        once = [TEMPLATES[h[0]][:2] for h in index.scan(text)]
        for times in (2, 3, 10):
            assert [TEMPLATES[h[0]][:2] for h in index.scan(" ".join([text] * times))] == once * times, (license_, name, times)


def test_many_copies_take_time_in_proportion():
    index, text, took = license_scan.Index(), " ".join(TEMPLATES[0][2].split()), []
    for times in (15, 30):
        started = time.process_time()
        assert len(index.scan(" ".join([text] * times))) == times
        took.append(time.process_time() - started)
    assert took[1] < 3 * took[0] + 0.5


def test_alignment_is_a_longest_common_subsequence():
    import numpy as np

    r = np.random.default_rng(1)
    for _ in range(60):
        text, template = r.integers(1, 5, 14), r.integers(1, 5, 7)
        table = np.zeros((15, 8), int)
        for i in range(14):
            for j in range(7):
                table[i + 1, j + 1] = table[i, j] + 1 if text[i] == template[j] else max(table[i, j + 1], table[i + 1, j])
        assert license_scan.align(text, template, -7, 14)[0] == table[-1, -1]


def test_query_against_plain_search(spark):
    notices = {"Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0": "Apache-2.0",
               "This work is licensed under the GNU General Public License, version 3": "GPL-3.0",
               "Released under the MIT License": "MIT", "All rights reserved": "LicenseRef-All-Rights-Reserved"}
    want = sorted((r.doc_id, name, m.start(), m.end()) for r in documents(spark).collect()
                  for notice, name in notices.items() for m in re.finditer(re.escape(notice), r.text))
    got = sorted((r.doc_id, r.license, r.start, r.end) for r in queries.op4_license_scan(spark, DATA).collect())
    assert want and got == want


def test_edge_rows(spark):
    rows = [(1, "x " * 50000 + "Released under the MIT License.", "en"), (None, "All rights reserved", None), (2, None, None), (2, "", "en")]
    got = sorted((r.doc_id or 0, r.license, r.start) for r in license_scan.scan(edge_rows(spark, rows)).collect())
    assert got == [(0, "LicenseRef-All-Rights-Reserved", 0), (1, "MIT", 100000)]
    assert license_scan.scan(edge_rows(spark)).collect() == license_scan.scan(edge_rows(spark, [])).collect() == []
