"""Notices that wrap over lines."""

from texloam.llm import licenses

MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */"""
TEXTS = {
    1: (MPL, "mpl-notice"),
    2: ("some words before it, and this code is licensed under the BSD\n3-Clause License, see there", "bsd-notice"),
    3: ("The pictures of this book are licensed under\nCC BY 4.0 by their authors.", "creative-commons-notice"),
    4: ("This is free and unencumbered\nsoftware released into\nthe public domain.", "public-domain-notice"),
    5: ("all " + "word " * 40 + "rights\n" + "word " * 40 + "reserved", None),
    7: ("This Source Code Form is subject\nto the terms of the\nMozilla Public License,\nv. 2.0.", "mpl-notice"),
    8: ("\n".join("text here and this code is licensed under the BSD 3-Clause License of old".split()), "bsd-notice"),
    9: (" ".join(["all"] + ["word"] * 999 + ["rights"] + ["word"] * 999 + ["reserved"] + ["word"] * 999), None),
    10: ("word " * 3000 + "all rights reserved" + " word" * 3000, "rights-reserved"),
    6: ("nothing\n\nhere", None),
}


def test_wrapped_notices(spark):
    frame = spark.createDataFrame([(i, t) for i, (t, _) in TEXTS.items()], "doc_id long, text string")
    for r in licenses.scan_licenses(frame).collect():
        label = TEXTS[r.doc_id][1]
        assert label in r.labels if label else r.labels == [], (r.doc_id, r.labels)
