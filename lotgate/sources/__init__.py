"""Sources: the CSV front end for submissions and the flat history file."""
