"""Reading and writing of pages, texts, link tables, vectors and models."""
