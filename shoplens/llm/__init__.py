"""Training-data operators: search, personal data, near copies, toxicity, passages, licences, tokens, quality, chats, mixing, whitening, tries."""
