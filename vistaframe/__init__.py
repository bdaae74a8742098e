"""Fleet-scale analytics over 3D scene captures, expressed as Spark plans."""
