"""DataFrame-to-DataFrame steps; none of them runs an action unless it says so."""
