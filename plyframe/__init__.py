"""plyframe: analytics over archives of turn-based games, written as Spark DataFrame jobs."""
