"""The tables users work with, composed from sources and operators."""
