from shelfwise.llm import licenses as L

SCHEMA = "doc_id long, text string, license string, line int"


def test_scan(spark):
    text = {
        1: "Released under the MIT License.\nbody text", 2: "x\nLicensed under CC BY-NC 4.0.",
        3: "This work is licenced under the GNU General Public License, version 3.", 4: "no notice here",
        5: "my driving license was renewed at the office", 6: "", 7: None,
        8: "word " * 3000 + "end. Licensed under the Apache License, Version 2.0. " + "word " * 3000,
    }
    rows = [(i, t, "clash", 0) for i, t in text.items()] + [(None, text[1], "", 0), (1, text[1], "", 0)]
    got = L.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    sure = sorted((repr(r.doc_id), r.line, r.license) for r in got if r.confirmed)
    assert sure == sorted([("1", 0, "MIT"), ("1", 0, "MIT"), ("2", 1, "CC-BY-NC-4.0"), ("3", 0, "GPL-3.0"),
                           ("8", 0, "Apache-2.0"), ("None", 0, "MIT")])
    three = next(r for r in got if r.doc_id == 3)
    assert three.missing == ["licensed"] and three.added == ["licenced"]
    assert [r.confirmed for r in got if r.doc_id == 5] == [False]
    assert not [r for r in got if r.doc_id in (4, 6, 7)]
    assert L.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_every_template_finds_itself():
    for name, texts in L.TEMPLATES.items():
        for t in texts:
            got = L.identify(t)
            assert got[0] == name and got[5] and got[2] == 1 and not got[3] and not got[4]


def test_wrapped_notice_of_each_template(spark):
    rows, want = [], []
    for name, texts in L.TEMPLATES.items():
        for t in texts:
            for mark in ("", " * ", "# ", "// "):
                parts = t.split()
                wrapped = "\n".join(mark + " ".join(parts[i:i + 4]) for i in range(0, len(parts), 4))
                rows.append((len(rows), f"int x;\n{wrapped}\nint y;", "", 0))
                want.append((len(want), 1, name))
    got = L.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.line, r.license) for r in got if r.confirmed) == want


def test_notice_anywhere_in_long_lines():
    notice = L.TEMPLATES["MIT"][1]
    for before in range(0, 90, 7):
        for filler in ("word", "license"):
            text = f"{filler} " * before + notice + f" {filler}" * 300
            got = [r for r in L.notices(text) if r[8]]
            assert [(r[2], r[3], r[5]) for r in got] == [(notice, "MIT", 1)]


def test_versions_variants_and_two_notices_in_a_line():
    for text, want in [
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("Licensed under the Apache License, Version 1.1.", ["Apache-1.1"]),
        ("Licensed under the Apache License, Version 3.0.", []),
        ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]), ("Licensed under CC BY-NC-ND 4.0.", ["CC-BY-NC-ND-4.0"]),
        ("Released under the BSD License.", []), ("SPDX-License-Identifier: MIT-0", ["MIT-0"]),
        ("Released under the MIT License. Licensed under the Apache License, Version 2.0. Licensed under CC BY 4.0.",
         ["MIT", "Apache-2.0", "CC-BY-4.0"]),
    ]:
        assert [r[3] for r in L.notices(text) if r[8]] == want, text


def edits(want, have):
    """Plain word edit distance in which words that tell licenses apart must stay."""
    cost = lambda w: L.NEVER if L._tells(w) else 1
    row = [sum(map(cost, have[:j])) for j in range(len(have) + 1)]
    for i, w in enumerate(want, 1):
        new = [row[0] + cost(w)]
        for j, h in enumerate(have, 1):
            new.append(min(row[j - 1] + (0 if w == h else max(cost(w), cost(h))), row[j] + cost(w), new[-1] + cost(h)))
        row = new
    return row[-1]


def test_places_are_the_least_edits_of_any_stretch():
    import random

    rng = random.Random(3)
    letters = ["a", "b", "c", "mit", "2"]
    for _ in range(150):
        want = rng.choices(letters, k=rng.randint(1, 6))
        have = rng.choices(letters, k=rng.randint(0, 12))
        every = {(i, j): edits(want, have[i:j]) for i in range(len(have) + 1) for j in range(i, len(have) + 1)}
        got = L.places(want, have, 2)
        for n, a, b, missing, added in got:
            assert n == every[a, b] and max(len(missing), len(added)) <= n + (n > 0) * len(want)
        if got:
            assert got[0][0] == min(every.values())
        else:
            assert min(every.values()) > 2


def mixed(seed):
    import random

    rng = random.Random(seed)
    filler = "the driver renewed a license for software that is provided with copyright in the distribution of words".split()
    parts = []
    for _ in range(6):
        notice = rng.choice([t for texts in L.TEMPLATES.values() for t in texts]).split()
        for _ in range(rng.randint(0, 1 + len(notice) // 8)):
            notice[rng.randrange(len(notice))] = rng.choice(filler)
        parts += [" ".join(rng.choices(filler, k=rng.randint(0, 40))), " ".join(notice) + rng.choice(["", ".", "\n"])]
    return " ".join(parts)


def test_nothing_below_the_bound_would_be_confirmed():
    sure = 0
    for seed in range(12):
        text = mixed(seed)
        every = L.notices(text, least=-(1 << 30))
        assert L.notices(text) == every
        sure += sum(r[8] for r in every)
    assert sure > 20


def test_the_ranking_decides(monkeypatch):
    text = L.TEMPLATES["MIT"][2]
    assert L.identify(text)[0] == "MIT" and not L.identify(text)[3]
    whole = [(r[2], r[3]) for r in L.notices(text) if r[8]]
    assert whole == [(text.rstrip(":"), "MIT")]
    unsaved = "you may take this software under some licence of ours"
    named = L.identify(unsaved)[0]
    monkeypatch.setattr(L, "reductions", lambda block: (100, [0] * len(L._templates())))
    L.identify.cache_clear()
    assert not [r for r in L.notices(text) if r[8]] and L.identify(unsaved)[0] != named
    L.identify.cache_clear()


def test_expressions_and_further_licenses():
    for text, want in [
        ("SPDX-License-Identifier: MIT OR Apache-2.0", ["MIT", "Apache-2.0"]),
        ("SPDX-License-Identifier: (GPL-2.0 AND BSD-3-Clause) OR MIT", ["GPL-2.0", "BSD-3-Clause", "MIT"]),
        ("This crate is dual-licensed under MIT and Apache-2.0.", ["MIT", "Apache-2.0"]),
        ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
        ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
        ("SPDX-License-Identifier: EUPL-1.2", ["EUPL-1.2"]), (L.TEMPLATES["Zlib"][0], ["Zlib"]),
        (" ".join(L._CLAUSES[:3]), ["BSD-2-Clause"]), (" ".join(L._CLAUSES), ["BSD-3-Clause"]),
        (" * ".join(c.lstrip("123. ") for c in L._CLAUSES), ["BSD-3-Clause"]),
        ("licensed under MIT and not much else", ["MIT"]),
    ]:
        assert [r[3] for r in L.notices(text) if r[8]] == want, text


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License.", 1, "x", 0.5, True)],
                               "doc_id long, text string, block int, missing string, saved double, confirmed boolean")
    assert [(r.license, r.confirmed) for r in L.scan(df).collect()] == [("MIT", True)]
