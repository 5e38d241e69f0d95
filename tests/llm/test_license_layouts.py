"""Licences in the layouts of real files, inside longer documents."""

from assaylake.llm import license_scan as ls
from tests.llm.helpers import prose, rows, table


def paragraphs(text, *starts):
    for start in starts:
        assert start in text
        text = text.replace(start, "\n\n" + start)
    return text


def test_headers_and_files_inside_longer_documents(spark, hard, nothing):
    apache = paragraphs(ls._APACHE, "You may obtain", "Unless required")
    bsd2 = paragraphs(f"{ls._BSD2} {ls._BSD_AS_IS}", "1. Redis", "2. Redis", "THIS SOFTWARE")
    bsd3 = paragraphs(f"{ls._BSD3} {ls._BSD_AS_IS}", "1. Redis", "2. Redis", "3. Neither", "THIS SOFTWARE")
    mit = paragraphs(f"{ls._MIT} {ls._AS_IS}", "The above copyright", "THE SOFTWARE IS")
    around = lambda i, x: f"{prose(i, 60)}.\n\nCopyright (c) 2020 A. Nother.\n\n{x}\n\n{prose(i + 50, 60)}"
    texts = [around(1, apache), around(2, bsd2), around(3, bsd3), around(4, mit)]
    texts += ["Some prose came first. Licensed under the MIT License. More of it.", prose(9, 300), "under the license", None]
    texts += ["Released under the MIT License " * 3]
    got = {(r["doc_id"], r["license_id"]) for r in ls.license_scan(table(spark, rows(*texts)), layouts=True).collect()}
    want = {(0, "Apache-2.0"), (1, "BSD-2-Clause"), (2, "BSD-3-Clause"), (3, "MIT"), (4, "MIT"), (8, "MIT")}
    assert got == want
    assert ls.license_scan(hard, layouts=True).collect() == [] and ls.license_scan(nothing, layouts=True).collect() == []


def test_needed_words_leave_too_few_pairs():
    for _, text in ls.FULL_TEMPLATES:
        grams = ls.bigrams(text)
        chosen = ls.needed_words(grams, 0.8)
        assert len([g for g in grams if not chosen & set(g.split())]) < ls.least_shared(len(grams), 0.8)
