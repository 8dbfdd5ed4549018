"""Tables the engine starts from."""
