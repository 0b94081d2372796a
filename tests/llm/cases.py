"""Rows that every operator and stage must take, and the small tables."""

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

LONG = " ".join(f"w{k * 7919 % 5003}x{k}" for k in range(30_000))
PLAIN = " ".join(f"{'abcdefghij'[k % 10]}{k * 37 % 91}" for k in range(120))
ODD_ROWS = [
    (1, "", "en", "a", 1),
    (2, None, "en", None, 2),
    (3, " \t\n\x0b ", None, "a", 3),
    (4, PLAIN, "en", "b", 4),
    (5, PLAIN, "en", "b", 5),
    (5, PLAIN, "en", "b", 5),
    (6, PLAIN + " tail", "en", "b", None),
    (7, LONG, "en", "a", 7),
    (8, "one two", "en", None, 8),
    (9, "ONE  two", "en", "c", 9),
    (10, "it's don't we'll  I've 12 3½ 中文 😀 <s> <|endoftext|> \n\n x y", "en", "c", 10),
    (11, "a\nb\nc\nd\na\nb\nc", "en", "c", 11),
    (12, "z\na\nb\nc", "en", "c", 12),
    (13, "word " * 200, "en", "c", 13),
    (14, "'s 't ' 　　x", "en", "c", 14),
    (None, PLAIN, None, None, None),
    (None, None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
