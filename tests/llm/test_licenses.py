"""License scan against Python's regular expressions."""

import re

from loomframe.llm.license_rules import rules
from loomframe.llm.licenses import scan_licenses

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = ["MIT License", "Licensed under the GNU Lesser General Public License, version 3. SPDX-License-Identifier: GPL-2.0-only",
         "the Apache License, Version 2.0 and BSD 3-clause license; MIT LICENSE https://opensource.org/licenses/MIT",
         "GNU General Public License version 2 ... all rights reserved. Copyright (c) 2020 x", "mit  license general public license apache\nlicense",
         "é Licenſe MIT—License", "CC-BY-SA 4.0 license. Licensed under the Creative Commons Attribution 4.0 license" * 3, "no such thing", "MITK License",
         "mit license " * 3000, "see LICENSE.txt for details; unlicense.org, http://www.gnu.org/licenses/agpl.html; PUBLIC DOMAIN; released into the public domain"]


def brute(text):
    t = (text or "").translate(ASCII)
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    base = sorted((i, label) for p, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
                  for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    spans = sorted({(m.start(), -m.end(), r.priority, r.number, r.label) for r in rules() for m in re.finditer(r.pattern, t, re.ASCII)})
    kept, ends = [], {1: -1, 2: -1, 3: -1}
    for s in spans:
        if not any(ends[p] >= -s[1] for p in ends if p <= s[2]):
            kept.append((s[0], -s[1], *s[2:]))
        ends[s[2]] = max(ends[s[2]], -s[1])
    return len(w), base, kept


def test_rules_are_many_and_their_keywords_hold():
    assert len(rules()) >= 200 and all(len(k) > 1 for r in rules() for k in r.keywords)


def test_scan_equals_brute_force(spark, odd, empty):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "doc_id long, text string")
    for r in scan_licenses(df).collect():
        n, base, kept = brute([*TEXTS, None][r["doc_id"]])
        assert r["n_words"] == n and [(b["start"], b["label"]) for b in r["base"]] == base
        assert [tuple(d) for d in r["detections"]] == kept
    assert scan_licenses(odd).count() == odd.count() and scan_licenses(empty).count() == 0


def test_contained_detections_are_suppressed(spark):
    df = spark.createDataFrame([(1, "under the Apache License, Version 2.0 here")], "doc_id long, text string")
    assert [d["label"] for d in scan_licenses(df).first()["detections"]] == ["apache-2.0"]


def test_a_long_text_of_matches_equals_brute_force(spark):
    text = "licensed under the mit license, apache license 2.0; " * 12_000
    r = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    n, base, kept = brute(text)
    assert r["n_words"] == n and [(b["start"], b["label"]) for b in r["base"]] == base and len(kept) >= 24_000
    assert [(d["start"], d["end"], d["priority"], d["rule"], d["label"]) for d in r["detections"]] == kept
