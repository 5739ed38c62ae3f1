"""Column functions: text, HTML, prompts, responses, and the Python plug points."""
