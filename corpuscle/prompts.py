"""Prompts for the model seams. Their wording is our own; answers are read by tolerant parsers."""

from __future__ import annotations

#: The labels of entities.
TYPES = "PERSON NORP FAC ORG GPE LOC PRODUCT EVENT WORK_OF_ART LAW LANGUAGE DATE TIME PERCENT MONEY QUANTITY ORDINAL CARDINAL UNBIS_TERM ACRONYM CUSTOM".split()
LINKING = "Give the Wikidata item of each entity below, which is one of the types " + ", ".join(TYPES) + "\nAnswer with a JSON list of [name, type, QID or null, confidence from 1 to 5], one for each entity, and nothing else.\n\n"
ACRONYMS = "List the acronyms that this text explains, as a JSON object from short to long form, and nothing else.\n\n"
SUMMARY = "Summarise what these passages have in common in one paragraph.\n\n"
#: A prompt holds so many characters of a text; a longer text is put into several, which overlap by ``SHARED``.
MOST, SHARED = 10_000, 400
