"""Rows of the small tables, with the awkward cases."""

PROSE = (
    "Every morning the old keeper walked along the quiet shore and wrote down what the sea had "
    "brought in during the night, from broken oars to small green bottles, because his daughter "
    "in the distant town liked to read such lists and would answer each one with a short story "
    "about where the things had come from and who might still be looking for them today."
)
SHARED = "A line that many documents share with one another, word by word."
ITEM = "The lighthouse at the northern cape was built by three brothers who never agreed on its height."


def documents():
    """(doc_id, text) with the awkward cases."""
    words = PROSE.split()
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t\n "),
        (4, PROSE),
        (5, PROSE),  # an exact copy
        (5, PROSE),  # the same row again
        (6, PROSE + "\n" + SHARED),
        (7, "Intro. " + ITEM + " Outro.\n" + SHARED.upper()),
        (8, "  " + SHARED + " \r\n" + SHARED + "\nshort"),
        (9, SHARED),
        (9, SHARED + "\nanother text of the same id, long enough to count"),
        (None, SHARED + "\nno id here"),
        (None, None),
        (10, "Ä ÖL Éa ß straße ÄÄ " + PROSE.upper()),
        (11, " ".join(["word"] * 3000)),
        (12, "a b"),
        (13, "Home | About | Contact | Shop\n" + PROSE),
        (14, "WIN!! BIG!! NOW!! " * 30),
        (15, "\n".join(["menu » item » next » last"] * 4)),
        (16, "released UNDER the MIT-License.\nLicensed under the Apache License, Version 2.0."),
        (17, "This work is licensed under the GNU General Public License, version 3."),
        (18, "Licensed under CC BY-NC 4.0. cc by nc cc by nc"),
        (19, "x" * 70_000),
        (20, "\n".join(f"{PROSE} {n}" for n in range(300))),
        (21, " ".join(words[5:] + words[:5]) + " " + ITEM),
        (22, "Click here\n" + PROSE + "\nAll rights reserved."),
        (23, "emoji \U0001f600 and\x00nul\x1fsep\x85nel\u2028ls " + PROSE),
        (24, "why no"),
    ]
    rows += [(100 + n, PROSE + f"\nNumber {n}.") for n in range(40)]
    return rows


def pages():
    """(page_id, url, html)."""
    return [
        (1, "http://www.example.com/en/1?x=1", "<p>one</p>"),
        (2, "https://Example.COM/en/2", "<p>one</p>"),
        (3, "http://a.b.example.net/es/x#y", ""),
        (4, None, None),
        (5, "no scheme/en/", "<p>two</p>"),
        (6, "http://free-bets.example.org/fr/", "<p>three</p>\r\n\r\nmore"),
        (6, "http://free-bets.example.org/fr/", "<p>three</p>\r\n\r\nmore"),
        (None, "https://m.free-bets.example.org", "<p>two</p>"),
        (None, "http://notexample.com", "<p>only here</p>"),
        (7, "http://example.net?q=/es/", "größe \U0001f600 " * 30_000),
        (8, "http://example.com/EN/", "größe \U0001f600 " * 30_000),
        (9, "://", "x"),
        (10, "a://b://c/en/", "x"),
        (11, "http://net/fr/a\nb", "line\nbreak"),
        (0, "http://x.example.com\r\nInjected: 1", "<p>one</p>"),
    ]


def benchmark():
    """(item_id, text)."""
    return [
        (1, ITEM),
        (2, None),
        (3, ""),
        (4, "why no"),
        (5, "why no"),
        (None, "cc by nc cc"),
        (6, "completely absent words zzz yyy xxx www vvv uuu ttt sss rrr qqq"),
        (7, PROSE),
        (7, "a b"),
    ]
