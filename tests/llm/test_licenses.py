import math
from collections import Counter

from riskflow.llm import licenses as L

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."


def files(spark, rows):
    return spark.createDataFrame([(*r, "x", 1.0, 2) for r in rows], "doc_id long, path string, text string, licence string, score double, row long")


def scan(spark, rows, **k):
    return {r["doc_id"]: r for r in L.scan(files(spark, rows), **k).collect()}


def test_nearest_ancestor_wins(spark, prose):
    rows = [
        (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."), (2, "a/b/COPYING.txt", MIT), (3, "a/x.py", prose(20)), (4, "a/b/c/d/y.py", prose(20)),
        (5, "a/c/z.py", "# Licensed under CC BY-NC 4.0.\n" + prose(300)), (6, "other/w.py", prose(20)), (7, "a/c/q.py", None), (8, None, "Released under the MIT License.\n" + prose(90)), (9, None, "x"),
    ]
    found = scan(spark, rows)
    assert {i: r["effective_licence"] for i, r in found.items()} == {1: "Apache-2.0", 2: "MIT", 3: "Apache-2.0", 4: "MIT", 5: "CC-BY-NC-4.0", 6: None, 7: "Apache-2.0", 8: "MIT", 9: None}
    assert found[4]["inherited_from"] == "a/b" and found[7]["inherited_from"] == "a" and found[5]["inherited_from"] is None
    assert [i for i in found if found[i]["licence_file"]] == [1, 2]


def test_scores_equal_plain_cosine(spark, prose):
    rows = [(i, f"p/{i}", t) for i, t in enumerate(["Released under the MIT License.", "This is released under the terms of the MIT License, see file.", prose(9) + ". Licensed under CC BY-NC 4.0, ok. " + prose(4), prose(30), MIT[:90]])]
    n, df = len(rows), Counter(t for _, _, text in rows for t in set(L.terms(text)))
    idf = lambda t: math.log((1 + n) / (1 + df[t])) + 1

    def cosine(a, b):
        a, b = ({t: c * idf(t) for t, c in Counter(L.terms(x)).items()} for x in (a, b))
        return sum(w * b.get(t, 0) for t, w in a.items()) / math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))

    found = scan(spark, rows, threshold=0.4)
    import re

    def passages(text):
        whole = L.sentences(text)
        sizes = {len(L.sentences(t)) for all_ in L.TEMPLATES.values() for t in all_}
        return re.split(r"\n|(?<=[.!?;])\s+", text) + [" ".join(whole[k : k + n]) for k in range(len(whole)) for n in sizes]

    for i, _, text in rows:
        best = max((round(cosine(s, t), 6) for s in passages(text) if L.terms(s) for all_ in L.TEMPLATES.values() for t in all_), default=0)
        assert (found[i]["score"] is None and best < 0.4) or abs(found[i]["score"] - best) < 1e-5, (i, best, found[i])


def test_odd_rows(spark, odd):
    rows = [(i, f"d/{i}", t) for i, t in odd] + [(None, "d/n", "x"), (50, "d/r", MIT), (50, "d/r", MIT)]
    out = L.scan(files(spark, rows)).collect()
    assert len(out) == len(rows) and sum(r["licence"] == "MIT" for r in out) == 2
    assert L.scan(files(spark, [])).collect() == []


def test_several_passages_give_one_row(spark):
    text = "Released under the MIT License.\nLicensed under CC BY 4.0.\nReleased under the MIT License."
    (r,) = L.scan(files(spark, [(1, "a", text)])).collect()
    assert r["licence"] == "MIT" and r["passage"] == 0


# Headers as they stand in source files, wrapped and commented.
GPL = """{mark} {subject} is free software{first} you can redistribute it and/or modify
{mark} it under the terms of the GNU {name}General Public License as published by
{mark} the Free Software Foundation{second} either version {version} of the License, or
{mark} (at your option) any later version.
{mark}
{mark} This program is distributed in the hope that it will be useful,
{mark} but WITHOUT ANY WARRANTY; without even the implied warranty of
{mark} MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
{mark} GNU {name}General Public License for more details.
"""
BSD = """{mark} Redistribution and use in source and binary forms, with or without
{mark} modification, are permitted provided that the following conditions are met:
{gap}{mark} 1. Redistributions of source code must retain the above copyright notice, this
{mark}    list of conditions and the following disclaimer.
{gap}{mark} 2. Redistributions in binary form must reproduce the above copyright notice,
{mark}    this list of conditions and the following disclaimer in the documentation
{mark}    and/or other materials provided with the distribution.
{third}{gap}{mark} THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
{mark} AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
{mark} IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
{mark} DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE FOR ANY DAMAGES.
"""
THIRD = """{gap}{mark} 3. Neither the name of Example Ltd nor the names of its contributors
{mark}    may be used to endorse or promote products derived from this software
{mark}    without specific prior written permission.
"""
MIT_WRAPPED = """{mark} Permission is hereby granted, free of charge, to any person obtaining a copy
{mark} of this software and associated documentation files (the "Software"), to deal
{mark} in the Software without restriction, including without limitation the rights
{mark} to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
{mark} copies of the Software, and to permit persons to whom the Software is
{mark} furnished to do so, subject to the following conditions:
{mark}
{mark} The above copyright notice and this permission notice shall be included in all
{mark} copies or substantial portions of the Software.
"""
APACHE = """{mark} Licensed under the Apache License, Version 2.0 (the "License");
{mark} you may not use this file except in compliance with the License.
{mark} You may obtain a copy of the License at
{mark}
{mark}     http://www.apache.org/licenses/LICENSE-2.0
"""


def headers():
    for mark in ("#", " *", "//", ""):
        gap = f"{mark}\n"
        third = THIRD.format(mark=mark, gap=gap)
        yield "AGPL-3.0", GPL.format(mark=mark, subject="This program", name="Affero ", version="3", first=":", second=",")
        yield "GPL-3.0", GPL.format(mark=mark, subject="This program", name="", version="3", first=":", second=",")
        yield "GPL-2.0", GPL.format(mark=mark, subject="This program", name="", version="2", first=";", second=";")
        yield "LGPL-3.0", GPL.format(mark=mark, subject="This program", name="Lesser ", version="3", first=":", second=",")
        yield "LGPL-2.1", GPL.format(mark=mark, subject="This library", name="Lesser ", version="2.1", first=";", second=";")
        yield "BSD-2-Clause", BSD.format(mark=mark, gap=gap, third="")
        yield "BSD-2-Clause", BSD.format(mark=mark, gap="", third="")
        yield "BSD-3-Clause", BSD.format(mark=mark, gap=gap, third=third)
        yield "BSD-3-Clause", BSD.format(mark=mark, gap="", third=THIRD.format(mark=mark, gap=""))
        yield "MIT", MIT_WRAPPED.format(mark=mark)
        yield "Apache-2.0", APACHE.format(mark=mark)


def test_wrapped_headers_get_their_own_licence(spark, prose):
    planted = list(headers())
    rows = [(i, f"src/{i}.c", f"# Copyright 2020 {prose(3)}\n" + text + "\n" + prose(200)) for i, (_, text) in enumerate(planted)]
    rows += [(1000 + i, f"src/p{i}.c", prose(120)) for i in range(200)]
    found = scan(spark, rows)
    assert {i: found[i]["licence"] for i in range(len(planted))} == {i: name for i, (name, _) in enumerate(planted)}
    assert all(found[1000 + i]["licence"] is None for i in range(200))


def test_whole_licence_files_are_known_without_a_name(spark, prose):
    planted = [("MIT", MIT_WRAPPED), ("BSD-2-Clause", BSD.replace("{third}", "")), ("BSD-3-Clause", BSD.replace("{third}", THIRD))]
    rows = [(i, f"p{i}/text", text.format(mark="", gap="\n")) for i, (_, text) in enumerate(planted)]
    rows += [(10 + i, f"p{i}/a/x.c", prose(60)) for i in range(3)]
    found = scan(spark, rows)
    assert [found[i]["licence_file"] for i in range(3)] == [True] * 3
    assert [found[10 + i]["effective_licence"] for i in range(3)] == [name for name, _ in planted]
