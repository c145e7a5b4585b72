"""Training-data operators: near duplicates, nearest neighbours, archives,
toxicity, sharding, tokenisation, chat formatting, personal data, benchmark
leaks and licences. Nothing else in the library imports this subpackage."""
