"""Column functions: hashed draws, native waveform expressions, Arrow waveform stages."""
