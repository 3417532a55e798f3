"""Operator 4: held-out wording, the unknown class, and the column expression against plain Python."""

from shelfspark.llm import licenses, queries

CORPUS = ("the river runs past the old mill and the green hills", "words of no matter at all in this line of text", "entirely other matters are told in these lines")
SEEN = [("Apache-2.0", "This code is licensed under the Apache License, Version 2.0."), ("MIT", "released under the mit license"), ("GPL-3.0", "This tool is licensed under the GNU General Public License, version 3 or later."), ("CC-BY-NC", "Licensed under CC BY-NC 4.0."), ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"), ("LGPL", "licensed under the GNU Lesser General Public License"), (None, "A fishing license is needed in these waters"), (None, "You need permission to enter"), (None, "released under pressure by the licensed operator")]


def test_families_and_unknown(spark):
    docs = spark.createDataFrame([(k, f"Some story.\n{t}\nThe end.") for k, (_, t) in enumerate(SEEN)], "doc_id long, text string")
    model = licenses.fit(CORPUS)
    got = {r.doc_id: [p.family for p in r.paragraphs if p.confirmed] for r in licenses.scan_licenses(docs, model=model).collect()}
    assert got == {k: [f] if f else [] for k, (f, _) in enumerate(SEEN)}


def test_column_scores_match_plain_python(spark):
    model = licenses.fit(CORPUS)
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(SEEN)], "doc_id long, text string")
    for r in licenses.scan_licenses(docs, model=model).collect():
        for p in r.paragraphs:
            want = model.probabilities(p.paragraph)
            assert abs(p.probability - max(want)) < 1e-6
            assert p.family == (model.classes[want.index(max(want))] if max(want) >= model.reject else licenses.UNKNOWN)


def test_op4_edges(edge, empty, store, spark):
    rows = queries.op4_license_paragraphs(spark, store(documents=edge)).collect()
    assert len(rows) == edge.count() and all(r.n_confirmed == 0 and r.families == "" for r in rows)
    assert queries.op4_license_paragraphs(spark, store(documents=empty)).count() == 0


def test_every_template_has_a_cue():
    for templates in licenses.TEMPLATES.values():
        for t in templates:
            assert any(c in t.lower() for c in (*licenses.CUES, *licenses.STEMS)), t


WRAPPED = {
    "MIT": 'MIT License\n\nCopyright (c) 2020 A. Writer\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n',
    "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n",
    "Apache-2.0": '# Licensed under the Apache License,\r\n# Version 2.0 (the "License"); you may\r\n# not use this file except in\r\n# compliance with the License.\r\n# You may obtain a copy of the License at\r\n',
    "GPL-3.0": " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n",
}


def test_wrapped_notices(spark):
    long = "\n".join(f"row {i} of a table with no stop" for i in range(400))
    rows = [(f, t) for f, t in WRAPPED.items()] + [(f"{f} in", f"{long}\n{t}{long}") for f, t in WRAPPED.items()]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: {p.family for p in r.paragraphs if p.confirmed} for r in licenses.scan_licenses(docs, model=licenses.fit(CORPUS)).collect()}
    assert got == {k: {k.split()[0]} for k, _ in rows}


def test_two_notices_one_below_the_other(spark):
    docs = spark.createDataFrame([(0, "Released under the MIT License\nLicensed under CC BY-NC 4.0\n")], "doc_id long, text string")
    got = licenses.scan_licenses(docs, model=licenses.fit(CORPUS)).first().paragraphs
    assert sorted(p.family for p in got if p.confirmed) == ["CC-BY-NC", "MIT"]


CUELESS_BEFORE = ["Distributed under CC BY-SA 4.0", "Available under the Apache 2.0 terms", "GPLv3 or later", "BSD 3-Clause", "CC0 1.0 Universal", "Lizenz: siehe Datei"]


def test_lines_without_the_word_license_are_scored(spark):
    docs = spark.createDataFrame(list(enumerate([*CUELESS_BEFORE, "the river runs past the old mill"])), "doc_id long, text string")
    got = {r.doc_id: r.paragraphs for r in licenses.scan_licenses(docs, model=licenses.fit(CORPUS)).collect()}
    assert [len(got[k]) for k in range(7)] == [1] * 6 + [0]
    assert [p.family for p in got[0] if p.confirmed] == ["CC-BY-SA"]


def test_what_holds_no_cue_cannot_be_confirmed():
    for t in [t for ts in licenses.TEMPLATES.values() for t in ts]:
        w = set(licenses.words_of(t))
        assert len(w - set(licenses.CUES) - {x for x in w if any(c in x for c in licenses.STEMS)}) < licenses.LEAST_OVERLAP * len(w), t


def test_licences_without_a_template_are_unknown(spark):
    foreign = ["Licensed under the European Union Public Licence 1.2", "Distributed under the Artistic License 2.0", "This font is under the SIL Open Font License", "a fishing licence for the whole family"]
    docs = spark.createDataFrame(list(enumerate(foreign)), "doc_id long, text string")
    model = licenses.fit(CORPUS)
    assert 0 < model.reject <= licenses.LEAST_PROBABILITY
    for r in licenses.scan_licenses(docs, model=model).collect():
        assert r.paragraphs and not any(p.confirmed for p in r.paragraphs), r
        assert all(p.family == "unknown" or p.probability < 0.9 for p in r.paragraphs), r


def test_sample_takes_lines_from_everywhere(spark):
    docs = spark.createDataFrame([(k, "first line of the text here\n" + f"line {k} is told far below and names no licence\n" + "Released under the MIT License") for k in range(50)], "doc_id long, text string")
    got = licenses.corpus_sample(docs, most=30)
    assert len(got) == 30 and got == licenses.corpus_sample(docs.repartition(7), most=30)
    assert sum("far below" in p for p in got) >= 28 and not any("mit license" in p for p in got)
    long = spark.createDataFrame([(1, "word " * 50_000)], "doc_id long, text string")
    assert [len(p.split()) for p in licenses.corpus_sample(long)] == [licenses.WINDOW]


def test_clashing_names(spark):
    docs = spark.createDataFrame([("x", "Released under the MIT License", "y")], "j string, text string, paragraphs string")
    got = licenses.scan_licenses(docs, keep=("j", "text", "paragraphs"), model=licenses.fit(CORPUS)).first()
    assert got.j == "x" and [p.family for p in got.paragraphs if p.confirmed] == ["MIT"]
