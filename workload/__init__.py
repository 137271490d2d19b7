"""The driver's tables shaped as disclosures, pages and cells, and the checked queries over them."""
