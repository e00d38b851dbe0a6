"""Small tables with the awkward rows every operator has to take."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, text_sha256 string"


def words(seed, n, size=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}é" if i % 7 == 0 else f"v{rng.randrange(size)}" for i in range(n))


def edited(text, every, mark):
    return " ".join(f"{mark}{i}" if i % every == every - 1 else w for i, w in enumerate(text.split(" ")))


def texts():
    base = words(1, 400)
    shared = words(2, 70)
    rows = [
        base, base, base + " tail", edited(base, 120, "x"), edited(base, 45, "y"),
        None, "", " \t\n", "one", "one two three", "ONE two Three four", "one two three four",
        shared, words(3, 90) + " " + shared + " " + words(4, 30), words(5, 11) + "\n" + shared + "\t" + words(6, 60),
        words(7, 6000, 3000), edited(words(7, 6000, 3000), 200, "z"), "a " * 300, "a " * 120, words(8, 49), words(8, 49),
        words(9, 50), words(9, 50), words(10, 51), "q " + words(10, 51), " nbsp  here wide",
        "<|endoftext|> It's 2024, they'll naïve ΟΔΟΣ İstanbul é \U0001f600\U0001f600 x<|startoftext|>y‍",
    ]
    return rows


def table():
    """Texts of all kinds, repeated rows, a null identifier, and columns with names an operator might use itself."""
    rows = [(10 * i, t, "en", "s", 1, "extra", "extra") for i, t in enumerate(texts())]
    rows.append(rows[3])
    rows.append((None, texts()[0], None, None, None, None, None))
    rows.append((30, "same id, other text", None, None, None, None, None))
    return rows


@pytest.fixture
def docs(frame):
    return frame(table(), SCHEMA)


@pytest.fixture
def empty(frame):
    return frame([], SCHEMA)
