"""Very long texts, lines and pages take time in proportion to their length."""

import random
import time

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer as Library

from plyframe.llm import bpe, html_text, line_dedup

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_long_text_without_blanks():
    """Twice the text takes about twice the time, not four times; ids as the library's."""
    own = bpe.Tokenizer(bpe.read_file(VOCABULARY))
    assert own.encode("ab," * 2000) == Library.from_file(VOCABULARY).encode("ab," * 2000, add_special_tokens=False).ids
    own.encode("ab," * 100)
    start = time.process_time()
    ids = own.encode("ab," * 350_000)
    assert time.process_time() - start < 30
    assert len(ids) % 350_000 == 0


def test_variants_against_all_deletions():
    """With every half wanted: a whole line, and one row per deletion in both roles."""
    r = random.Random(5)
    for _ in range(40):
        line = "".join(r.choice("abé") for _ in range(r.randrange(20, 30)))
        rows = line_dedup.variants(line, 15)
        keys = {}
        for role, place, key in rows.tolist():
            keys.setdefault(role, {})[place] = key
        assert len(np.unique(rows, axis=0)) == len(rows)
        shorter = [line[:i] + line[i + 1 :] for i in range(len(line))]
        assert sorted(keys[0]) == list(range(len(line))) and list(keys[1]) == [len(line)]
        # Equal deletions share a key, others do not; a deletion's key is that of the whole shorter line.
        assert len({keys[0][i] for i in range(len(line))}) == len(set(shorter)) == int((rows[:, 0] == 2).sum())
        for i, text in enumerate(shorter):
            if len(text) >= line_dedup.MIN_CHARS:
                assert line_dedup.variants(text, 1)[0].tolist() == [1, len(text), keys[0][i]]


def test_many_lines_and_a_long_line(spark):
    long = "x" * 2_500_000 + "y" * 2_500_000
    lines = [f"line {i // 2}" for i in range(200_000)]
    rows = [(1, "\n".join(lines)), (2, long), (3, long[1:]), (4, None), (4, None), (5, "line 7")]
    start = time.monotonic()
    got = {x.doc_id: x for x in line_dedup.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string"), 1).collect()}
    assert time.monotonic() - start < 60
    assert (got[1].n_lines, got[1].n_removed, got[1].text) == (200_000, 100_000, "\n".join(lines[::2]))
    assert got[2].text == long and (got[3].text, got[3].n_removed) == ("", 1)
    assert (got[4].text, got[4].n_lines, got[5].text) == (None, 0, "")


def test_deep_pages():
    start = time.process_time()
    assert len(html_text.blocks("<div>a " * 50_000)) == 50_000
    html_text.main_text("<div><i><div>" + "<b>" * 50_000 + "</i>" * 50_000)
    assert time.process_time() - start < 30


SAYS = "A paragraph of the text, which has marks, and goes on; so it counts as a body does."


def test_page_wide_form():
    page = f"<body><form action=x><div><p>{SAYS}</p><p>{SAYS} Again.</p></div><div class=footer><p>Ours.</p></div></form></body>"
    assert html_text.main_text(page) == f"{SAYS}\n\n{SAYS} Again."
    page = f"<body><div><p>{SAYS}</p></div><form><p>Your mail, please.</p></form></body>"
    assert html_text.main_text(page) == SAYS


def test_headings_and_lists_of_an_unnamed_body():
    body = f"<h2>Head</h2><p>{SAYS}</p><ul><li>one<li>two</ul><p>{SAYS}</p><table><tr><td>1<td>2</table>"
    menu = "<ul><li><a href=a>Home</a><li><a href=b>News</a></ul>"
    page = f"<body><div class=top>{menu}</div><div class=x>{body}</div><div class=footer><p>Ours.</p></div></body>"
    assert html_text.main_text(page) == f"Head\n\n{SAYS}\n\none\n\ntwo\n\n{SAYS}\n\n1\n\n2"
    assert html_text.main_text(f"<body>{menu}{body}</body>").startswith("Head\n\n")


def test_deep_link_and_deep_closing():
    """A link counts whatever stands between it and the text, and its end tag closes it."""
    found = html_text.blocks("<p><a href=x>" + "<b>" * 20 + "far</b></a> away</p>")
    assert [(b.text, b.linked) for b in found] == [("far away", 3)]
