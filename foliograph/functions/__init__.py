"""Column functions: text keys, names and signatures, small scalars."""
