"""Column expressions: text cleaning, the Student-t tail, harmonic and discount sums."""
