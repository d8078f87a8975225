"""tokenloom: word co-occurrence and term scoring over large text, on Spark."""
