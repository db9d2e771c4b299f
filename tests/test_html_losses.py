"""What pages hold comes through: texts of lists, terms, numbers, titles, code; and any depth in little time."""

import time

import pytest

from quire.operators.html import to_markdown as md


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<ul>intro<li>a</li>\n</ul>", "intro\n- a"),
        ("<ul><li>x<ol>and<li>a</li></ol></li></ul>", "- x\n  and\n  1. a"),
        ("<dl><dt>t</dt><dd>d</dd><dt>u</dt><dd><p>e</p><p>f</p></dd></dl>", "t\n\n:   d\n\nu\n\n:   e\n\n    f"),
        ('<ol start="5"><li>a</li><li>b</li></ol>', "5. a\n6. b"),
        ('<ol start="x"><li>a</li></ol>', "1. a"),
        ('<a href="u" title=\'T "q"\'>t</a><img src="s" alt="i" title="k">', '[t](u "T \\"q\\"")![i](s "k")'),
        ("<p><code>a`b</code> <code>c</code> <code>``</code></p>", "`` a`b `` `c` ``` `` ```"),
        ("<ul><li>a<pre>x\n\ny</pre>b</li></ul>", "- a\n```\nx\n\ny\n```\nb"),
        ("<pre>a\n```\nb</pre>", "````\na\n```\nb\n````"),
        ("<blockquote>a<blockquote>b<p>c</p></blockquote></blockquote>", "> a\n>\n> > b\n> >\n> > c"),
        ("<ul><li><blockquote>q<p>r</p></blockquote></li></ul>", "- > q\n>\n> r"),
        ("<table><tr><td><blockquote>q</blockquote></td></tr></table>", "| > q |\n| --- |"),
        ("<b><blockquote>q</blockquote></b>", "**> q**"),
        ("<blockquote></blockquote>", ">"),
        ("x﷐y﷒z<p>&#xfdd0;k</p>", "xyz\n\nk"),
    ],
)
def test_content_is_kept(page, want):
    assert md(page) == want


@pytest.mark.parametrize(("unit", "levels"), [("<blockquote>w", 5000), ("<ul><li>w", 3000), ("<ol><li><blockquote>w", 2000)])
def test_time_grows_with_the_output(unit, levels):
    began = time.time()
    text = md(unit * levels)
    assert text.count("w") == levels and time.time() - began < 15


def test_lists_of_sixty_levels_keep_their_indents():
    assert md("".join(f"<ul><li>w{k}" for k in range(60))).split("\n")[-1] == "  " * 59 + "- w59"
