"""The licence scan against a brute-force reading of its rules."""
import re

from nearfill.llm import license_rules, license_scan

ROWS = [
    (1, "Licensed under the Apache License, Version 2.0 (the License)"), (2, None), (3, ""), (4, "no licence here"),
    (5, "MIT License. mit-license MIT/License"), (5, "MIT License. mit-license MIT/License"), (None, "CC BY-NC-SA 4.0"),
    (6, "SPDX-License-Identifier: GPL-3.0-or-later\nGNU General Public License version 3 or later"),
    (7, "GNU Lesser General Public License v2.1; gplv2+ LGPLv3"), (8, "marK MİT License K license mit"),
    (9, "word " * 3000 + "Creative Commons Attribution-ShareAlike 3.0 Unported License " * 40),
    (10, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
         "documentation files (the Software)"), (11, "BSD 3-Clause License; New BSD License"),
]
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    base, labels, found, sure = [], set(), [], [0.0]
    for j, x in enumerate(w):
        for number, r in enumerate(license_rules.rules()):
            if r.anchor == x and (m := re.match(f"({r.pattern})(?= |$)", " ".join(w[j:j + license_rules.WINDOW_WORDS]))):
                if r.base:
                    base.append(j)
                    labels.add(r.label)
                    sure.append(license_rules.CONFIDENCE[r.priority])
                else:
                    found.append((r.priority, j, j + len(m[1].split()), number, r.label))
    kept = set(labels)
    for a in found:
        if not any(b[1] <= a[1] and b[2] >= a[2] and (b[0] > a[0] or b[0] == a[0] and (
                b[2] - b[1] > a[2] - a[1] or b[1:3] == a[1:3] and b[3] < a[3])) for b in found):
            kept.add(a[4])
            sure.append(license_rules.CONFIDENCE[a[0]])
    return (len(w), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(labels)),
            ",".join(sorted(kept)), max(sure))


def test_report_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in ROWS], "doc_id long, text string, row int, labels string")
    got = [tuple(r) for r in license_scan.report(docs).collect()]
    assert sorted(got, key=str) == sorted([(i, *brute(t)) for i, t in ROWS], key=str)


def test_containment_and_priority(spark):
    rule = license_rules.Rule
    rules = [rule("inner", 1, "b", "b c"), rule("outer", 1, "a", "a b c d"), rule("strong", 3, "c", "c d"),
             rule("twin", 1, "b", "b c"), rule("cross", 1, "d", "d e")]
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    kept = {r.d.label for r in license_scan.scan(docs, rules).collect()}
    assert kept == {"outer", "strong", "cross"}


def test_there_are_hundreds_of_rules_and_empty_tables_work(spark):
    rules = license_rules.rules()
    assert len(rules) > 300 and all(r.needs and re.match(r.anchor, r.pattern) for r in rules)
    assert license_scan.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
