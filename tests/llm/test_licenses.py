import math
import random

from gleanery.llm import licenses
from tests.llm.test_texts import words_of

MIT = """Permission is hereby granted, free of charge, to any person obtaining
a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish,"""
BSD = """# Redistribution and use in source and binary forms, with or
# without modification, are permitted provided that the following
# conditions are met:"""


def brute_runs(text, templates, threshold):
    words, found = words_of(text), []
    for label, body in templates:
        sequence = words_of(body)
        want = set(sequence)
        if not want:
            continue
        if len(sequence) < 10:
            if any(words[i : i + len(sequence)] == sequence for i in range(len(words))):
                found.append((label, 1.0))
            continue
        span, need = math.ceil(len(sequence) / threshold - 1e-9), max(1, math.ceil(threshold * len(want) - 1e-9))
        rivals = [set(words_of(t)) for other, t in templates if other != label]
        rivals = [r for r in rivals if len(r & want) >= need]
        beside = set(zip(sequence, sequence[1:]))
        for i in range(max(1, len(words) - span + 1)):
            run = words[i : i + span]
            both, near = len(set(run) & want), set(zip(run, run[1:])) & beside
            own = set().union(*(want - r for r in rivals)) if rivals else set()
            if any(not any(w in pair for pair in near) for w in own) or any(want < r and r - want <= set(run) for r in rivals):
                continue
            if both >= threshold * len(want) - 1e-9:
                found.append((label, both / len(want)))
    return sorted({label for label, _ in found}), max((x for _, x in found), default=0.0)


def by_id(docs, **options):
    return {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs, **options).collect()}


def test_wrapped_notices_are_found(make):
    far = " ".join(f"x{i} " * 40 + w for i, w in enumerate("licensed under cc by nc 4 0".split()))
    head = "word " * 5000
    rows = [MIT, BSD, "Licensed under CC BY-NC\n4.0", far, f"{head}\n{MIT}\n{head}"]
    got = by_id(make(rows))
    assert [got[0][0], got[1][0], got[4][0]] == ["mit", "bsd", "mit"] and min(got[i][1] for i in (0, 1, 4)) >= 0.85
    assert got[2] == ("cc-by-nc", 1.0)
    assert got[3] == ("", 0.0)


def test_licences_that_differ_by_a_word_are_told_apart(make):
    rows = ["Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.", "x\nLicensed under CC BY 4.0.\ny"]
    got = by_id(make(rows))
    assert [got[0], got[1]] == [("cc-by-nc", 1.0), ("cc-by-sa", 1.0)]
    assert got[2] == ("cc-by", 1.0)
    gpl, lgpl = (next(text for label, text in licenses.TEMPLATES if label == x) for x in ("gpl", "lgpl"))
    got = by_id(make([gpl, lgpl, gpl + ". Lesser parts are free."]))
    assert [got[i][0] for i in range(3)] == ["gpl", "gpl,lgpl", "gpl"]  # the phrase says gpl
    assert {r.label for r in licenses.similar_blocks(make([lgpl])).collect()} == {"lgpl"}


def test_names_are_not_made_of_words_of_others(make):
    want = {
        "Figures CC BY-NC 4.0 text CC BY-SA 4.0 code CC BY-ND 4.0": "cc-by-nc,cc-by-nd,cc-by-sa",
        "cc by-nc and by-sa 4.0": "",
        "CC BY 4.0 (NC use of SA logo is allowed)": "cc-by",
        "version 2.0 CC BY 4 lines": "",
        "licensed under CC BY 4.0": "cc-by",
        "CC-BY-NC-ND 4.0": "cc-by-nc-nd",
    }
    got = by_id(make(list(want)))
    assert {text: got[i][0] for i, text in enumerate(want)} == want


def test_runs_equal_brute_force(make, odd_texts):
    rng = random.Random(8)
    rows = list(odd_texts)
    for _ in range(60):
        _, body = rng.choice(licenses.TEMPLATES)
        words = [w for w in body.split() if rng.random() < 0.95]
        for _ in range(rng.randint(0, 4)):
            words.insert(rng.randint(0, len(words)), rng.choice("the of and new".split()))
        pad = ["of", "the", "pad"] * rng.randint(0, 60)
        rows.append("\n".join(pad + words + pad[: rng.randint(0, 90)]))
    rows += [rows[-1], "mit " * 100]
    docs = make(list(enumerate(rows)))
    for threshold in (licenses.THRESHOLD, 0.5):
        want = {i: brute_runs(t, licenses.TEMPLATES, threshold) for i, t in enumerate(rows)}
        for r in licenses.scan(docs, threshold=threshold).collect():
            labels, best = want[r.doc_id]
            base = r.base_labels.split(",") if r.base_labels else []
            assert (r.labels, r.score) == (",".join(sorted({*labels, *base})), 1.0 if base else best), rows[r.doc_id]
    assert licenses.scan(docs.where("false")).collect() == []
    assert {r.labels for r in licenses.scan(make(["a b"]), templates=[]).collect()} == {""}


def test_runs_need_no_python(make):
    plan = licenses.scan(make(["mit license"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_places_of_phrases_after_emoji(make):
    rows = ["\U0001f600\U0001f600\U0001f600 x MIT license y mit license", "\U0001f600" * 40 + "\nApache License"]
    got = {r.doc_id: (r.n_words, r.first_word, r.last_word) for r in licenses.scan(make(rows)).collect()}
    assert got == {0: (7, 2, 5), 1: (3, 1, 1)}


def test_usual_notices_have_templates(make):
    gnu = "{} is free software: you can redistribute it and/or modify\nit under the terms of the GNU {} as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."
    want = {
        "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at": "apache",
        gnu.format("This program", "General Public License"): "gpl",
        gnu.format("This library", "Lesser General Public License"): "gpl,lgpl",
        gnu.format("This program", "Affero General Public License"): "agpl,gpl",
        "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0.": "mpl",
        "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.": "isc",
        "This work is licensed under a Creative Commons Attribution 4.0\nInternational License.": "cc-by",
        "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License": "cc-by-nc-sa",
        "a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
        "CC BY-NC-SA 4.0": "cc-by-nc-sa",
        "CC BY 4.0": "cc-by",
        "CC0 1.0 Universal": "cc0",
        "This is free and unencumbered software released into\nthe public domain.": "unlicense",
        MIT: "mit",
        BSD: "bsd",
    }
    got = by_id(make(list(want)))
    assert {text: got[i][0] for i, text in enumerate(want)} == want
