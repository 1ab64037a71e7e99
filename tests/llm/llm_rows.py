"""Rows with every awkward case."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, node long"
LONG = " ".join(f"w{i % 701}x{i % 89}" for i in range(30_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "b"),
    (3, "The quick brown fox jumps over the lazy dog near the river bank tonight.", "en", None),
    (4, None, None, "a"),
    (5, "", "en", "a"),
    (6, " \t\n ", "en", "c"),
    (7, "one two three", "en", "c"),
    (8, "One TWO three", "en", "c"),
    (9, "Straße Ärger Öl über die Brücke; il fait très beau aujourd'hui — it's 12.5 °C 😀", "de", "b"),
    (10, LONG, "en", "a"),
    (11, LONG + " tail", "en", "a"),
    (12, "12345 67890", "en", "a"),
    (12, "a repeated id with another text", "en", "a"),
    (13, "same row", "en", "a"),
    (13, "same row", "en", "a"),
    (None, "a row without an id", "en", "a"),
]
