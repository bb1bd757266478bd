import math
import re
from collections import Counter

import pytest

from loomline.llm import licenses

SCHEMA = "doc_id long, path string, text string"
MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
PROSE = "the time and the year of the people, a way of the world. "


def brute_scan(text, counts, total, least=licenses.LEAST):
    """Cosine of the text, each line and each sentence to every template."""
    def tokens(x):
        return re.findall("[a-z0-9]+", "".join(c.lower() if c.isascii() else " " for c in x))

    def vector(x):
        return {t: (1 + math.log(n)) * (math.log((1 + total) / (1 + counts.get(t, 0))) + 1) for t, n in Counter(tokens(x)).items()}

    best = None
    passages = [text]
    for line in (text or "").split("\n"):
        passages += [line, *re.split(r"(?<=[.!?:;])[ \t]+", line)]
    for passage in passages:
        v = vector(passage or "")
        for name, examples in licenses.TEMPLATES.items():
            for example in examples:
                w = vector(example)
                dot = sum(x * w[t] for t, x in v.items() if t in w)
                cosine = dot / math.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in w.values())) if v else 0
                if cosine >= least and (
                    best is None or (round(cosine, 9), [-ord(c) for c in name]) > (round(best[1], 9), [-ord(c) for c in best[0]])
                ):
                    best = (name, cosine)
    return best


def rows():
    texts = [
        MIT,
        APACHE,
        PROSE * 5,
        PROSE + "\n" + MIT + "\n" + PROSE,
        PROSE + APACHE,
        "released under a license",
        None,
        "",
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 2.",
        "This work is licensed under the GNU General Public License, version 3.",
        "MIT",
        "// SPDX-License-Identifier: MIT",
        PROSE * 2000 + "\n# Licensed under the GNU Lesser General Public License, version 3.",
    ]
    return [(k, f"d/{k}.txt", x) for k, x in enumerate(texts)]


def test_scan_is_that_of_all_passages_and_templates(spark):
    given = rows()
    wanted = {t for texts in licenses.TEMPLATES.values() for x in texts for t in re.findall("[a-z0-9]+", x.lower())}
    counts = Counter(t for _, _, x in given for t in set(re.findall("[a-z0-9]+", (x or "").lower())) & wanted)
    found = {x["doc_id"]: x for x in licenses.scan_licences(spark.createDataFrame(given, SCHEMA)).collect()}
    for doc, _, text in given:
        want = brute_scan(text, counts, len(given))
        assert found[doc]["direct"] == (want and want[0]), text and text[:60]
        if want:
            assert found[doc]["score"] == pytest.approx(want[1])
    assert found[9]["direct"] == "GPL-2.0" and found[10]["direct"] == "GPL-3.0"


def test_nearest_directory_hands_its_licence_down(spark):
    given = [
        (1, "LICENSE", MIT),
        (2, "a/LICENSE.txt", APACHE),
        (3, "a/b/c/x.py", PROSE),
        (4, "z/y.py", PROSE),
        (5, "a/own.py", MIT + "\n" + PROSE),
        (6, "a/b/COPYING", PROSE),
        (7, "root.py", None),
        (8, "ab/x.py", PROSE),
        (9, "a/notice.py", APACHE),
        (10, None, PROSE),
    ]
    found = {
        x["doc_id"]: (x["licence"], x["origin"], x["from_dir"]) for x in licenses.licence_scan(spark.createDataFrame(given, SCHEMA)).collect()
    }
    assert found == {
        1: ("MIT", "file", None), 2: ("Apache-2.0", "file", None), 3: ("Apache-2.0", "inherited", "a"), 4: ("MIT", "inherited", ""), 5: (
            "MIT", "header", None
        ),
        6: ("Apache-2.0", "inherited", "a"), 7: ("MIT", "inherited", ""), 8: ("MIT", "inherited", ""), 9: ("Apache-2.0", "file", None), 10: (
            "MIT", "inherited", ""
        ),
    }


def test_without_any_licence_repeated_rows_and_empty_table(spark):
    given = [(None, "a/x", PROSE), (1, "a/x", PROSE), (1, "a/x", PROSE)]
    found = licenses.licence_scan(spark.createDataFrame([(*r, 1, 2) for r in given], SCHEMA + ", dir int, direct int")).collect()
    assert [(x["licence"], x["origin"]) for x in found] == [(None, "none")] * 3
    assert licenses.licence_scan(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_windows(text, counts, total):
    """The greatest cosine of a template and a window of its length."""
    def vector(tokens):
        return {t: (1 + math.log(n)) * (math.log((1 + total) / (1 + counts.get(t, 0))) + 1) for t, n in Counter(tokens).items()}

    tokens, best = re.findall("[a-z0-9]+", text.lower()), 0
    for example in (x for examples in licenses.TEMPLATES.values() for x in examples):
        own = re.findall("[a-z0-9]+", example.lower())
        w = vector(own)
        for i in range(len(tokens) - len(own) + 1):
            v = vector(tokens[i : i + len(own)])
            dot = sum(x * w[t] for t, x in v.items() if t in w)
            best = max(best, dot / math.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in w.values())))
    return best


def test_tokens_of_no_template_weigh_by_their_true_frequency(spark):
    filler = [(k, f"d/{k}", "en on " + PROSE) for k in range(400)]
    inside = APACHE.replace("under", "en under on"), MIT.replace("under", "en under")
    given = [*filler, *((400 + k, f"e/{k}", x) for k, x in enumerate(("en on " + APACHE, "en " + MIT, *inside, "zyzzyva quux plover xyzzy en " + MIT)))]
    counts = Counter(t for _, _, x in given for t in set(re.findall("[a-z0-9]+", x.lower())))
    found = {x["doc_id"]: x for x in licenses.scan_licences(spark.createDataFrame(given, SCHEMA)).collect()}
    assert [found[k]["direct"] for k in range(400, 405)] == ["Apache-2.0", "MIT", "Apache-2.0", "MIT", "MIT"]
    for doc in range(400, 405):
        want = brute_scan(given[doc][2], counts, len(given))
        assert found[doc]["score"] == pytest.approx(max(want[1] if want else 0, brute_windows(given[doc][2], counts, len(given))))
    assert 0.8 < found[402]["score"] < 1 and all(found[k]["direct"] is None for k in range(400))


def wrapped(text, width, mark=""):
    import textwrap

    return "\n".join(mark + x if x else mark.rstrip() for part in text.split("\n") for x in textwrap.wrap(part, width))


def test_equal_and_very_long_texts(spark):
    given = [(1, "a/x", PROSE * 40_000 + MIT), (2, "b/LICENSE", APACHE + "\n" + APACHE), (3, "b/LICENSE", MIT), (4, "b/LICENSE", MIT), (5, "b/y", None)]
    found = {x["doc_id"]: (x["licence"], x["origin"]) for x in licenses.licence_scan(spark.createDataFrame(given, SCHEMA)).collect()}
    assert found == {1: ("MIT", "header"), 2: ("Apache-2.0", "file"), 3: ("MIT", "file"), 4: ("MIT", "file"), 5: ("Apache-2.0", "inherited")}


@pytest.mark.parametrize("width,mark", [(30, "// "), (60, " * "), (76, "")])
def test_licences_that_are_wrapped_over_lines_are_found(spark, width, mark):
    texts = {}
    for name, examples in licenses.TEMPLATES.items():
        for example in examples:
            if len(example) > 60:
                texts[len(texts)] = (name, f"{mark}Copyright (c) 2020 Someone, some street in some town\n" + wrapped(example, width, mark) + "\n\n" + PROSE * 60)
    filler = [(1000 + k, f"d/{k}", PROSE + "Copyright (c) 2020 Someone") for k in range(200)]
    given = [(k, f"e/{k}", text) for k, (_, text) in texts.items()]
    found = {x["doc_id"]: x["direct"] for x in licenses.scan_licences(spark.createDataFrame(given + filler, SCHEMA)).collect()}
    for k, (name, text) in texts.items():
        assert found[k] == name, (name, found[k], text[:200])
    assert all(found[1000 + k] is None for k in range(200))


def test_windows_are_all_that_reach_the_least():
    import random

    rng = random.Random(4)
    words = [x.decode() for x in licenses.tokens_of((MIT + APACHE + PROSE).encode())]
    index = licenses.Index({"MIT": [MIT], "Apache-2.0": [APACHE]}, {b"the": 50, b"license": 40, b"under": 30}, 60, licenses.LEAST)
    for _ in range(200):
        tokens = [x.encode() for x in rng.choices(words, k=rng.randint(1, 40))]
        at = rng.randrange(len(tokens))
        tokens[at:at] = licenses.tokens_of(rng.choice([MIT, APACHE]).encode())
        for k, size in enumerate(index.sizes):
            every = [tokens[i : i + size] for i in range(len(tokens) - size + 1)]
            want = [x for x in every if index.stated(x, k) and index.stated(x, k).most >= licenses.LEAST]
            got = [x for j, x in index.windows(tokens) if j == k and index.stated(x, k)]
            assert got == want
