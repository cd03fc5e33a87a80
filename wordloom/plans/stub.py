"""A deterministic stand-in for the external labelling model, so that label queries can be checked."""

from wordloom.operators.labelling import FENCE, RESPONSE_HEADER, UNKNOWN

# The stub's answers depend on the length of the word only.
STUB_POS = ("kata nama", "kata kerja", "kata sifat", "kata hubung", "bukan kategori")


def _definition(word: str) -> str:
    size = len(word)
    if size % 9 == 0:
        return UNKNOWN
    if size % 8 == 0:
        return f"kata nama {word}"
    if size % 7 == 0:
        return f"makna {word}, huraian"
    return f"makna {word}"


def _row(word: str, following: str) -> str:
    size = len(word)
    fields = [
        word,
        _definition(word),
        UNKNOWN if size % 3 == 0 else f"anti{word}",
        UNKNOWN if size % 4 == 0 else following,
        STUB_POS[size % 5],
        "n/a" if size % 13 == 0 else str(size * 37 % 201 - 100),
    ]
    if size % 11 == 0:
        fields.pop()
    return ",".join(f'"{field}"' for field in fields)


def stub_labeller(words: list[str]) -> str:
    """CSV rows for the words in order; a word's synonym is the next word of the batch."""
    rows = [_row(word, words[(i + 1) % len(words)]) for i, word in enumerate(words)]
    return "\n".join([FENCE, RESPONSE_HEADER, *rows, FENCE])
