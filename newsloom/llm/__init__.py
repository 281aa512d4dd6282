"""Training-corpus operators. Nothing else in newsloom imports this subpackage."""
