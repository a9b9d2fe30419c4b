"""Operators for training corpora: archives, language, tokens, packing, chats,
personal data, secrets, decontamination and near duplicates.

Nothing outside this package imports it.
"""
