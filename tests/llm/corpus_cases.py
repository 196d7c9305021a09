"""Values that several tests of the corpus operators share."""

import public_tokenizers

SMALL = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def path_of(name):
    return public_tokenizers.path(name)
