"""Training-data operators (texts, conversations, captures); nothing else in the library imports this subpackage."""
