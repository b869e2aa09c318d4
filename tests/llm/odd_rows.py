"""Texts that are easy to get wrong."""

ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "One two",
    "same text that is here twice, with some more words to make it longer than a shingle",
    "same text that is here twice, with some more words to make it longer than a shingle",
    "A B  c\x0bd\x1ce   f <|endoftext|> #|& 'tis 12.5 é́",
    "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.",
    "line one has words\nline one has words\n\nline one has words\n!!",
    " ".join(f"w{k % 11}" for k in range(400)),
    " ".join(f"long{k}" for k in range(30_000)),
]
