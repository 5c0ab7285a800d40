"""Small helpers that the tests of this folder share."""

import hashlib


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()
