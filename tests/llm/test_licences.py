import pytest

from kinmatch.llm.licences import RULES, SENTENCES, Recognizer, _TELLING, with_licences

from .helpers import ROWS, clashing, documents, empty

MIT = "\n".join(f"# {SENTENCES[s][0]}." for s in ("mit-grant", "mit-condition", "mit-warranty", "mit-liability"))


def wrapped(text, width=50):
    """Lines of at most about ``width`` characters, each after a comment mark."""
    out, line = [], "#"
    for word in text.replace("# ", "").split():
        if len(line) > width:
            out.append(line)
            line = "#"
        line += " " + word
    return "\n".join([*out, line])


def names(text):
    return [x[0] for x in Recognizer()(text)[0]]


def test_every_sentence_can_be_met_and_every_rule_has_known_ones():
    assert all(any(w in t.lower() for w in _TELLING) for v in SENTENCES.values() for t in v)
    assert all(s in SENTENCES for _, wanted in RULES for s in wanted)
    for name, wanted in RULES:
        assert names("\n".join(SENTENCES[s][0] + "." for s in wanted)) == [name]


@pytest.mark.parametrize(("text", "want"), [
    ("", []), ("No word of it.", []), ("We like the MIT License very much.", []),
    ("ends***\nReleased under the MIT License.", ["MIT"]), ("RELEASED  UNDER THE mit licence", ["MIT"]),
    (MIT, ["MIT"]), (wrapped(MIT), ["MIT"]), (wrapped(MIT, 13), ["MIT"]),
    ("Copyright (c) 2020 Somebody\nAll rights reserved.\n" + MIT, ["MIT"]),
    (SENTENCES["mit-warranty"][0] + ".", ["unknown"]),
    ("Licensed under CC BY-NC 4.0.\nx\nReleased under the MIT License.", ["CC-BY-NC-4.0", "MIT"]),
    ("// Licensed under the Apache License, Version 2.0 (the \"License\");\n// you may not use this file except in compliance "
     "with the License.\n// You may obtain a copy of the License at\n//   http://x.org\n// " + SENTENCES["apache-basis"][0] + ".", ["Apache-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("xReleased under the MIT License.", []), ("Released under the MIT License2", []),
])
def test_texts(text, want):
    assert names(text) == want


def test_order_decides():
    grant, condition, warranty, liability = ([s] for s in ("mit-grant", "mit-condition", "mit-warranty", "mit-liability"))
    text = "\n".join(SENTENCES[s[0]][0] + "." for s in (condition, grant, warranty, liability))
    assert names(text) == ["unknown"] * 4


def test_places():
    text = "Some prose.\nReleased under the MIT License.\nMore."
    (name, start, end), = Recognizer()(text)[0]
    assert text[start:end] == "Released under the MIT License."


def test_awkward_documents(spark):
    long = " ".join(["word"] * 50_000) + "\nReleased under the MIT License."
    rows = [*ROWS, (50, long, None, None, None)]
    df = clashing(documents(spark, rows))
    out = with_licences(df)
    assert set(out.columns) == set(df.columns)
    found = {r["doc_id"]: (r["licences"], r["sentences"]) for r in out.collect()}
    assert found[50][1] == ["mit-notice"] and all(v == ([], []) for k, v in found.items() if k != 50)
    assert out.count() == len(rows) and with_licences(empty(spark)).count() == 0


def test_query_against_the_lines(spark, sf):
    from kinmatch.llm.queries import QUERIES

    lines = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    texts = {d["doc_id"]: d["text"] or "" for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op9_licences"](spark, sf).collect():
        want = sorted({n for line, n in lines.items() if line in texts[r["doc_id"]].split("\n")})
        assert r["licence_names"] == ",".join(want)
