"""Model selection over large labelled tables, written as Spark jobs."""
