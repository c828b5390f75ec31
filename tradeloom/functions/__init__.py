"""Column functions: text, number and date parsing, money arithmetic, safe division."""
