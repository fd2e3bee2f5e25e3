"""Column functions: text, labels, skills, URLs, HTML and gender rules."""
