"""Documents that every operator must take, and brute-force helpers."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

# Extra columns that bear names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, rep long, words string"

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(70))
CASES = [
    (1, f"one two three {PASSAGE} four", "en"),
    (2, f"other start {PASSAGE} other end", "en"),
    (2, f"other start {PASSAGE} other end", "en"),  # a repeated row
    (3, None, "en"),
    (4, "", None),
    (5, " \t\n ", "de"),
    (6, LONG, "en"),
    (7, "Mail a.b@c.example.com or +1 (555) 555-0100 4111111111111111 now 10.20.30.40, done.", "en"),
    (8, "Ünïcödé   text with é and 中文 and \x1c marks <|endoftext|> too", "fr"),
    (9, "x" * 50_000, "en"),
    (None, "a row without an id " * 3, "en"),
    (None, None, None),
    (10, "same words in a row here", "en"),
    (11, "SAME words in a row here", "en"),
]


def documents(spark, rows=None):
    rows = CASES if rows is None else rows
    return spark.createDataFrame(
        [(i, t, lang, "src", None if t is None else len(t), True, 7, "clash") for i, t, lang in rows], SCHEMA
    )


def words_of(text):
    return WORDS.findall(text or "")
