"""Physical choices: how rows are laid out before an operator runs."""
