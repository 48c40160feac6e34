"""A foreign source of evidence: how often a unit's text has a word, in plain Python."""


def says_motion(rows):
    for ord_, text in rows:
        yield text, text.lower().split().count("motion"), ord_
