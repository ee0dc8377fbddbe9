import pytest
from pyspark.sql import functions as F

from billwright.llm import licences
from llm_cases import DOCS, docs

MIT = licences.KNOWN["MIT"]


def _found(spark, texts, known=None):
    rows = [(n, text, None, None) for n, text in enumerate(texts)]
    result = licences.scan(docs(spark, rows), licences.known_digests(spark, known)).collect()
    return [row["licence"] for row in sorted(result)]


def test_variants_of_one_text(spark):
    variants = [
        MIT,
        MIT.upper(),
        "Copyright (c) 2020 Somebody\n" + MIT,
        " * Copyright 1999-2004, A. Person\n// (C) 2001 B\n© C\n" + MIT + "\nAll rights reserved.",
        " ".join(MIT.split()),
        MIT.replace(",", " ;").replace('"', "''"),
    ]
    assert _found(spark, variants) == ["MIT"] * len(variants)


def test_other_texts(spark):
    texts = [
        MIT + " extra", MIT.replace("free of charge", "for a charge"), "", None, "Copyright 2020 X",
        "the licence", "MIT", licences.KNOWN["0BSD"], licences.KNOWN["BSD-2-Clause"].replace("\n", "\r\n"),
    ]
    assert _found(spark, texts) == [None] * 7 + ["0BSD", "BSD-2-Clause"]


def test_spellings(spark):
    known = {"x": "the license license of an organization while willful"}
    assert _found(spark, ["The licence, licence of an organisation whilst wilful."], known) == ["x"]
    assert _found(spark, ["licences"], {"x": "licenses"}) == [None]


def test_two_names_of_one_text_and_no_texts(spark):
    assert _found(spark, ["a b", "c"], {"second": "A B", "first": "a, b", "empty": " - "}) == ["first", None]
    assert _found(spark, ["a b"], {}) == [None]


def test_every_known_text_is_told_apart(spark):
    assert licences.known_digests(spark).count() == len(licences.KNOWN)


def test_whole_licences_and_titles(spark):
    notice = "\n\nCopyright (c) 2020 Somebody\n\n"
    common = [(n, f"/usr/share/common-licenses/{f}") for n, f in (("Apache-2.0", "Apache-2.0"), ("GPL-3.0", "GPL-3"))]
    texts = [open(path, encoding="utf-8").read() for _, path in common]
    texts += ["MIT License" + notice + MIT, "Licensed under CC BY-NC 4.0.", licences.KNOWN["BSD-3-Clause"]]
    names = [name for name, _ in common] + ["MIT, titled MIT License", None, "BSD-3-Clause"]
    assert _found(spark, texts) == names


def test_odd_rows(spark):
    rows = licences.scan(docs(spark), licences.known_digests(spark)).collect()
    assert len(rows) == len(DOCS) and all(r["licence"] is None for r in rows)
    assert licences.scan(docs(spark, []), licences.known_digests(spark)).collect() == []


def test_native(spark):
    """No Python runs on the executors."""
    plan = licences.scan(docs(spark), licences.known_digests(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "InArrow"))


@pytest.mark.parametrize("line", ["copyright holder or contributors be liable", "(c) the third point"])
def test_lines_that_are_no_notices_stay(spark, line):
    text = spark.range(1).select(licences.canonical(F.lit(f"a\n{line}\nb"))).first()[0]
    assert line.split()[-1] in text
